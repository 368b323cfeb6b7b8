"""python -m quillmesh CORPUS COMMAND: the stages of a corpus from the command line, over files."""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from quillmesh.corpus import Corpus
from quillmesh.functions import dom
from quillmesh.operators import rdf
from quillmesh.operators.clustering import Config, grid, sweep
from quillmesh.session import local_session
from quillmesh.sources import readers, tables


class Numbers(argparse.Action):
    """Several numbers in one argument, between commas or blanks."""

    def __call__(self, parser, namespace, values, option_string=None):
        try:
            setattr(namespace, self.dest, list(map(int, values.replace(",", " ").split())))
        except ValueError:
            parser.error(f"{option_string}: whole numbers expected, not {values!r}")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser("quillmesh", description="The stages of a corpus of web pages.")
    p.add_argument("corpus", help="folder of the corpus")
    s = p.add_subparsers(dest="command", required=True)
    s.add_parser("discover", help="merge sitemap files").add_argument("sitemaps")
    s.add_parser("outcomes", help="merge a Parquet table of fetch outcomes").add_argument("table")
    c = s.add_parser("parse", help="parse what is pending")
    c.add_argument("--force", action="store_true")
    c.add_argument("--limit", type=int, default=0)
    c.add_argument("--namespaces")
    c.add_argument("--unconfirmed", action="store_true")
    c.add_argument("--file", help="parse one page file and show its record; nothing is written")
    c.add_argument("--sample", type=int, default=0, help="report on so many stored pages; nothing is written")
    for name, told in (("crawl", "follow the site's listings"), ("fetch", "fetch what is pending")):
        c = s.add_parser(name, help=told)
        c.add_argument("--transport", required=True, help="module:function, url -> (status, body)")
        for option in ("--most-pages", "--most-empty", "--delay") if name == "crawl" else ("--limit",):
            c.add_argument(option, default=0)
    c = s.add_parser("shape", help="the shape of a class in an N-Triples file")
    c.add_argument("triples")
    c.add_argument("--type", default="http://www.w3.org/1999/02/22-rdf-syntax-ns#type")
    c.add_argument("--of", required=True, help="the class")
    c.add_argument("--form", choices=("shex", "shacl"), default="shex")
    s.add_parser("assign", help="give new pages to the clusters of a kept run").add_argument("run")
    s.add_parser("extract", help="structure tokens of new and changed pages").add_argument("--limit", type=int, default=0)
    for name in ("cluster", "sweep"):
        c = s.add_parser(name)
        c.add_argument("--algorithm", choices=("hdbscan", "kmeans", "both"), default="hdbscan")
        c.add_argument("--components", action=Numbers, default=[30])
        c.add_argument("--min-df", action=Numbers, default=[2])
        c.add_argument("--k", action=Numbers, default=[8])
        c.add_argument("--min-cluster-size", action=Numbers, default=[100])
        c.add_argument("--min-samples", type=int, default=10)
        c.add_argument("--weights", choices=("presence", "counts", "both"), default="presence")
        if name == "cluster":
            c.add_argument("--write-back", action="store_true")
    s.add_parser("stats")
    return p.parse_args(argv)


def configs(a: argparse.Namespace) -> list[Config]:
    """Every combination of the listed values; a cluster run takes the first."""
    algorithms = ["hdbscan", "kmeans"] if a.algorithm == "both" else [a.algorithm]
    binaries = {"presence": [True], "counts": [False], "both": [True, False]}[a.weights]
    return grid(algorithms, a.min_df, binaries, a.components, a.k, a.min_cluster_size, min_samples=a.min_samples)


def named(path: str):
    """The function that module:function names."""
    module, _, function = path.partition(":")
    return getattr(importlib.import_module(module), function)


def main(argv: list[str] | None = None) -> int:
    a = arguments(argv)
    spark = local_session("quillmesh", "*")
    corpus = Corpus(spark, a.corpus)
    if a.command == "discover":
        found = readers.sitemap_files(spark, a.sitemaps)
        out = corpus.discover(found.where("kind = 'url'").selectExpr("loc as url", "lastmod"))
    elif a.command == "outcomes":
        out = corpus.save_outcomes(spark.read.parquet(a.table))
    elif a.command == "crawl":
        out = corpus.crawl(named(a.transport), readers.CrawlConfig.from_parameters(vars(a)))
    elif a.command == "fetch":
        out = corpus.scrape(named(a.transport), limit=int(a.limit))
    elif a.command == "shape":
        t = readers.triples(spark, a.triples)
        own = rdf.about(t, rdf.instances(t, a.type, a.of))
        shapes = rdf.shape(own).join(rdf.value_kinds(own), "p")
        print((rdf.shex(shapes, "Shape") if a.form == "shex" else rdf.shacl(shapes, "Shape", a.of)).first()[0])
        return 0
    elif a.command == "assign":
        out = corpus.assign(a.run)
    elif a.command == "parse" and a.file:
        with open(a.file, encoding="utf-8") as f:
            out = dom.entry(f.read(), None, corpus.site)
    elif a.command == "parse" and a.sample:
        out = corpus.sample_report(a.sample)
    elif a.command == "parse":
        out = corpus.parse(force=a.force, limit=a.limit, namespaces=a.namespaces, confirmed_only=not a.unconfirmed)
    elif a.command == "extract":
        out = corpus.extract(a.limit)
    elif a.command == "cluster":
        out = corpus.cluster(configs(a)[0], a.write_back)
    elif a.command == "sweep":
        from quillmesh.operators.features import token_counts

        tokens = token_counts(tables.feature_tokens(corpus.read("dom_features"), 1), "url")
        out = [r.asDict() for r in sweep(tokens, "url", configs(a)).orderBy("place").collect()]
    else:
        out = corpus.stats()
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
