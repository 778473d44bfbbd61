"""Runs the warehouse's jobs: `python -m marketmill build train index ask ...`.

Jobs of one call share a session. With a metastore they can also run one by one, each on
its own schedule.
"""

from __future__ import annotations

import argparse
import importlib
import sys
from datetime import datetime, timezone

from marketmill.operators.embed import DIMENSIONS, embed_question, embedded, hashed_words
from marketmill.operators.nearest import TOP_K
from marketmill.plans.build import MART_NAMESPACES, build_all
from marketmill.plans.catalog import ensure_catalog, index_catalog, question_hits
from marketmill.plans.training import CUSTOMERS, MARKETPLACE, train_and_record
from marketmill.session import build_session
from marketmill.sources.tables import Warehouse

HASHED = "words"  # the offline embedder

EXPERIMENTS = {
    "mart_customer_orders": CUSTOMERS,
    "mart_olist_customer_orders": MARKETPLACE,
}


def parse(arguments: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="marketmill")
    parser.add_argument("jobs", nargs="+", choices=("build", "train", "index", "ask"))
    parser.add_argument("--warehouse", required=True, help="root folder of all tables")
    parser.add_argument("--prefix", default="", help="put before the namespaces")
    parser.add_argument("--landing", help="folder of the marketplace files")
    parser.add_argument("--seeds", help="folder of the seed files")
    parser.add_argument("--bucket", help="read the landing files here if one is not local")
    parser.add_argument("--resume", action="store_true", help="skip steps finished from the same input")
    parser.add_argument("--manifests", help="catalog document, or a folder of them")
    parser.add_argument("--question")
    parser.add_argument(
        "--embedder",
        default=HASHED,
        help="`module:function` from a list of texts to their vectors; `none` skips indexing",
    )
    parser.add_argument("--dimensions", type=int, default=DIMENSIONS)
    parser.add_argument("--hits", type=int, default=TOP_K)
    parser.add_argument("--master", help="Spark master, where the submitter sets none")
    found = parser.parse_args(arguments)
    needs = {"build": ("landing", "seeds"), "index": ("manifests",), "ask": ("question",)}
    for job in found.jobs:
        for name in needs.get(job, ()):
            if getattr(found, name) is None:
                parser.error(f"{job} needs --{name}")
    return found


def embedder(name: str):
    """A function from rows with `description` to the same rows with `embedding`, or None."""
    if name == HASHED:
        return hashed_words
    if name == "none":
        return None
    module, _, function = name.partition(":")
    own = getattr(importlib.import_module(module), function)
    return lambda rows, **names: embedded(rows, own, **names)


def main(arguments: list[str] | None = None) -> dict:
    """Run the jobs in the order given; returns what each of them reports."""
    given = parse(arguments)
    spark = build_session(master=given.master)
    warehouse = Warehouse(spark, given.warehouse, given.prefix)
    now = datetime.now(timezone.utc)
    reports = {}
    embed = embedder(given.embedder)
    for job in given.jobs:
        if job == "build":
            reports[job] = build_all(
                warehouse, given.landing, given.seeds, given.bucket, resume=given.resume
            ).rows
        elif job == "train":
            reports[job] = {
                experiment.name: train_and_record(
                    warehouse, warehouse.read(MART_NAMESPACES[mart], mart), experiment, now
                ).metrics
                for mart, experiment in EXPERIMENTS.items()
            }
        elif job == "index":
            reports[job] = index_catalog(
                warehouse, given.manifests, embed, now, size=given.dimensions, model=given.embedder
            )
        else:
            reports[job] = ask(warehouse, given.question, embed or hashed_words, given.hits)
        print(f"{job}: {reports[job]}")
    return reports


def ask(warehouse: Warehouse, question: str, embed, hits: int) -> str:
    """The context of a question; its matches are printed with their similarity.

    Without any match the program ends with status 1.
    """
    vector = embed_question(warehouse.spark, question, embed)
    found = question_hits(ensure_catalog(warehouse), vector, hits)
    if not found:
        print("nothing found: index the catalog first", file=sys.stderr)
        raise SystemExit(1)
    for line, similarity in found:
        print("[none]" if similarity is None else f"[{similarity:.3f}]", line)
    return "\n".join(line for line, _ in found)


if __name__ == "__main__":
    main()
