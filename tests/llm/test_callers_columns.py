"""Columns of the caller come back as they were, whatever their names."""

from __future__ import annotations

import pytest

from marketmill.llm import (
    decontamination,
    language_id,
    line_dedup,
    packing,
    simhash,
    substring_dedup,
    suffix_dedup,
)

HELPERS = (
    "_chances _kept _id _row _ranges _hits _node _likely _place _word _mask _part _fill _rises _home "
    "_shift home shift row rows node component held_out score lang_pred predicted n_words n_removed "
    "n_bytes n_spans n_lines n_dropped body sequence_id offset piece length key label rank text_sha256"
).split()
PASSAGE = " ".join(f"word{i}" for i in range(40))
TEXTS = [f"own {i} words here\nshared line\n{PASSAGE if i % 3 else 'short text'}" for i in range(24)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text, "en" if i % 2 else "de", *[f"{name} {i}" for name in HELPERS]) for i, text in enumerate(TEXTS)]
    columns = "doc_id long, text string, lang string, " + ", ".join(f"`{x}` string" for x in HELPERS)
    return spark.createDataFrame(rows, columns).repartition(3)


def unchanged(found, replaced=()):
    """The rows of `found` have the caller's values in all columns but `replaced`."""
    rows = found.collect()
    assert rows
    for row in rows:
        for name in HELPERS:
            if name not in replaced:
                assert row[name] == f"{name} {row['doc_id']}", name


def test_stages_return_the_columns_of_their_input(spark, docs):
    items = spark.createDataFrame([(1, "nothing like it at all in here")], "item_id long, text string")
    for stage in (
        language_id.in_known_language(docs, least_score=0.0),
        simhash.one_of_each(docs),
        decontamination.without_benchmark(docs, items),
    ):
        assert stage.columns == docs.columns
        unchanged(stage)


def test_operators_replace_only_what_they_say(docs):
    unchanged(language_id.identify(docs), {"held_out", "lang_pred", "score"})
    unchanged(line_dedup.drop_common_lines(docs), {"n_lines", "n_dropped"})
    unchanged(substring_dedup.drop_repeated_words(docs), {"n_words", "n_removed"})
    unchanged(suffix_dedup.drop_repeated_bytes(docs), {"body", "n_bytes", "n_removed", "n_spans"})


def test_packing_passes_other_columns_on(docs):
    pieces = docs.drop("length").selectExpr("*", "CAST(7 AS BIGINT) AS length")
    unchanged(packing.pack(pieces, 20), {"sequence_id", "offset", "length"})
