"""Thin command line over the three stages: ``build``, ``embed`` and ``query``.

Exit codes: 0 fine, 1 a gate or strict mode failed, 2 bad arguments, data or index,
3 the retrieval check failed.
"""

from __future__ import annotations

import argparse
import importlib
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import articles, encoders, gates, images, index, reports, retrieval, session, stats
from .sources import mdx_corpus, tables

#: Probes of the retrieval check: give your own with --probes, a JSON list of (kind, query, keywords).
PROBES = ({"kind": "in-domain", "query": "how to configure and set up", "keywords": []}, {"kind": "out-of-domain", "query": "zqx jvk wqz", "keywords": []})


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="folioscope")
    stages = top.add_subparsers(dest="stage", required=True)
    build = stages.add_parser("build", help="tree of articles to shards and report")
    build.add_argument("--data", required=True)
    build.add_argument("--out", required=True)
    build.add_argument("--max-image-edge", type=int, default=4096)
    build.add_argument("--keep-frames", action="store_true")
    build.add_argument("--shard-rows", type=int, default=256)
    build.add_argument("--strict", action="store_true")
    build.add_argument("--seed", type=int, default=0, help="accepted; nothing is random")
    build.add_argument("--limit", type=int, default=0)
    embed = stages.add_parser("embed", help="shards to index and report")
    query = stages.add_parser("query", help="lines from standard input to rankings")
    for own in (embed, query):
        own.add_argument("--dataset", required=True)
        own.add_argument("--embed-file", required=True, help="index folder")
        own.add_argument("--modality", choices=("text", "image", "image_text"), default="image_text")
        own.add_argument("--encoder", default="", help="module:factory of an encoder; the hashing stand-in if empty")
    embed.add_argument("--data", default="", help="tree to check the order against")
    embed.add_argument("--multi-image", choices=("primary", "concat", "native"), default="primary")
    embed.add_argument("--batch-size", type=int, default=8)
    embed.add_argument("--part-rows", type=int, default=128)
    embed.add_argument("--image-cell", type=int, default=512)
    embed.add_argument("--force-regenerate", action="store_true")
    embed.add_argument("--top-k", type=int, default=100)
    embed.add_argument("--limit", type=int, default=None)
    embed.add_argument("--tag", default="index")
    embed.add_argument("--probes", default="")
    query.add_argument("--top-k", type=int, default=10)
    query.add_argument("--snippet", type=int, default=110)
    query.add_argument("--show-chars", type=int, default=16000)
    return top


def encoder_of(name: str):
    if not name:
        return encoders.HashEncoder()
    module, _, factory = name.partition(":")
    return getattr(importlib.import_module(module), factory)()


def run_build(spark: SparkSession, a: argparse.Namespace) -> int:
    began = time.perf_counter()
    if not os.path.isdir(a.data) or not mdx_corpus.discover(a.data):
        raise index.StageFailure("BUILD", f"no articles below {a.data}", 2)
    built = articles.build_articles(spark, a.data, images.default_decoder(), a.max_image_edge, a.keep_frames, a.limit)
    counted = stats.counters(built)
    refused = gates.strict_failures(counted) if a.strict else []
    violations = [{"rule": "strict", "message": r} for r in refused]
    smoke: list[dict] = []
    if not refused:
        os.makedirs(a.out, exist_ok=True)
        tables.write_shards(built.articles, a.out, a.shard_rows)
        again = tables.read_articles(spark, f"{a.out}/*.parquet")
        violations = [r.asDict() for r in gates.hard_gate(again, built.flagged, counted["converted"]).limit(1000).collect()]
        smoke = [r.asDict() for r in gates.handoff_gate(again, built.flagged).collect()]
    reports.build_report(a.out, built, violations, smoke, time.perf_counter() - began, a.max_image_edge)
    return 1 if violations or smoke else 0


def run_embed(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.limit is not None and a.limit <= 0:
        raise index.StageFailure("EMBED", "--limit must be positive", 2)
    rows = tables.read_articles(spark, f"{a.dataset}/*.parquet")
    if a.limit:
        rows = rows.filter(F.col("row_idx") < a.limit)
    expected = articles.ids.with_ids(mdx_corpus.read_corpus(spark, a.data)).select("row_idx", "id") if a.data and os.path.isdir(a.data) else None
    verified = gates.verify(rows, expected)
    if verified["failures"]:
        raise index.StageFailure("VERIFY", "; ".join(verified["failures"][:5]), 1)
    encoder = encoder_of(a.encoder)
    loop = index.build_or_resume(rows, encoder, a.embed_file, a.part_rows, a.modality, a.multi_image, a.image_cell, a.batch_size, a.force_regenerate)
    probes = list(PROBES)
    if a.probes:
        import json

        with open(a.probes, encoding="utf-8") as file:
            probes = json.load(file)
    said = retrieval.smoke(index.open_index(spark, a.embed_file), rows, encoder, probes, a.top_k)
    reports.index_report(a.embed_file, a.tag, a.dataset, verified, loop, said, a.modality, a.multi_image, command=sys.argv)
    return 0 if said["passed"] else 3


def run_query(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = tables.read_articles(spark, f"{a.dataset}/*.parquet")
    own = session.Session(rows, index.open_index(spark, a.embed_file), encoder_of(a.encoder), a.top_k, a.snippet, a.show_chars)
    for line in sys.stdin:
        result = own.execute(line)
        if result.status == "exit":
            break
        print(result.message)
        if isinstance(result.value, list):
            for r in result.value:
                print(f"{r['rank']:>3} {r['score']:.3f} {r['bar']} {r['id']} {r['n_images']} {r['snippet']}" if hasattr(r, "asDict") else f"    {r}")
    return 0


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName("folioscope").getOrCreate()
    try:
        return {"build": run_build, "embed": run_embed, "query": run_query}[a.stage](spark, a)
    except index.StageFailure as e:
        print(e, file=sys.stderr)
        return e.code


if __name__ == "__main__":
    sys.exit(main())
