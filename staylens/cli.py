"""Command-line entry points for the two command-line jobs of the surveyed
workload, as thin wrappers over the operators (run with ``spark-submit`` or
``python -m staylens.cli``). Inputs are tab-separated files with a header
(and for TF-IDF a listing -> neighbourhood map); results are written as
tab-separated files with a header.

    python -m staylens.cli tfidf --listings L.tsv --neighbourhoods N.tsv --listing 42 --out OUT
    python -m staylens.cli tfidf --listings L.tsv --neighbourhoods N.tsv --neighbourhood Ballard --out OUT
    python -m staylens.cli alternatives --listings L.tsv --calendar C.tsv 42 2016-12-15 10 2.5 20 --out OUT
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from staylens.operators import alternatives, terms
from staylens.sources import read_tsv, write_delimited
from staylens.sources import schemas


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    ap = argparse.ArgumentParser(prog="staylens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("tfidf", help="top-100 TF-IDF terms of one listing or neighbourhood")
    t.add_argument("--listings", required=True)
    t.add_argument("--neighbourhoods", required=True, help="TSV with id and neighbourhood columns")
    g = t.add_mutually_exclusive_group(required=True)
    g.add_argument("--listing", type=int)
    g.add_argument("--neighbourhood")
    t.add_argument("--top", type=int, default=100)
    t.add_argument("--out", required=True)
    a = sub.add_parser("alternatives", help="alternative listings for one listing on a date")
    a.add_argument("--listings", required=True)
    a.add_argument("--calendar", required=True)
    a.add_argument("listing_id", type=int)
    a.add_argument("date")
    a.add_argument("max_price_increase_pct", type=float)
    a.add_argument("max_km", type=float)
    a.add_argument("n", type=int)
    a.add_argument("--include-self", action="store_true")
    a.add_argument("--out", required=True)
    for p in (t, a):
        p.add_argument("--mode", default="errorifexists", help="Spark save mode for --out")
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"staylens-{args.cmd}").getOrCreate()
    listings = read_tsv(spark, args.listings, schemas.LISTINGS)
    if args.cmd == "tfidf":
        nb = read_tsv(spark, args.neighbourhoods, schemas.NEIGHBOURHOOD_MAP)
        corpus = terms.listing_corpus(listings.select("id", "description"), nb)
        if args.listing is not None:
            result = terms.tfidf_top_terms(corpus, args.listing, "listing", args.top)
        else:
            result = terms.tfidf_top_terms(corpus, args.neighbourhood, "neighbourhood", args.top)
    else:
        calendar = read_tsv(spark, args.calendar, schemas.CALENDAR)
        result = alternatives.alternative_listings(
            listings,
            calendar,
            args.listing_id,
            args.date,
            args.max_price_increase_pct,
            args.max_km,
            args.n,
            include_self=args.include_self,
        )
    write_delimited(result, args.out, sep="\t", header=True, mode=args.mode)


if __name__ == "__main__":
    main()
