"""Every stage of the pipeline on its own input against plain Python; accuracy of the models."""

from __future__ import annotations

import collections
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marketmill.llm import language_id, quality

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
COMMON = {
    "en": "the of and to in is you that it he was for on are as with his they at be this have from",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es",
}


def drawn(rng, lang, words):
    common = COMMON[lang].split()
    return [str(w) if rng.random() < 0.7 else f"{w}{lang}{rng.integers(0, 4000)}" for w in rng.choice(common, words)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = np.random.default_rng(0)
    item = " ".join(f"item{n} word" for n in range(12))
    texts = {}
    for i in range(160):
        lang = ("en", "de")[i % 2]
        words = drawn(rng, lang, int(rng.integers(40, 200)))
        lines = [" ".join(words[k : k + 12]) for k in range(0, len(words), 12)]
        if i % 4 == 0:
            lines.insert(1, "  Subscribe to OUR newsletter ")
        if i % 20 == 5:
            lines.insert(2, item)
        texts[i] = (lang, "\n".join(lines))
    for i in range(160, 190):  # near copies: a word in the last line is another one
        lang, text = texts[i - 150]
        texts[i] = (lang, text.rsplit(" ", 1)[0] + f" changed{i}")
    texts[190], texts[191], texts[192] = ("en", "12345 !!! 678"), ("en", ""), (None, None)
    rows = [(i, text, lang, "s", len(text or "")) for i, (lang, text) in texts.items()]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(4).write.parquet(f"{folder}/documents.parquet")
    items = spark.createDataFrame([(1, item), (2, "not in any text of this corpus at all")], "item_id long, text string")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "sequences"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {row["doc_id"]: row["text"] for row in docs.collect()}
        shape = docs.columns
        docs = corpus_pipeline.stored(stage(spark, docs, corpus), f"test-{name}")
        if name == "sequences":
            break
        assert docs.columns == shape
        kept[name] = {row["doc_id"]: row["text"] for row in docs.collect()}
        want = {
            "language": lambda: {i: t for i, t in before.items() if t and any(c.isalpha() for c in t)},
            "lines": lambda: without_lines(before),
            "near_duplicates": lambda: without_copies(before),
            "benchmark": lambda: {i: t for i, t in before.items() if "item3 word item4" not in t},
        }[name]()
        assert kept[name] == want, name
    assert len(kept["near_duplicates"]) < len(kept["lines"]) - 20
    plain = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    ends = collections.Counter()
    for row in docs.orderBy("sequence_id", "offset").collect():
        ids = np.array([*plain.encode(kept["benchmark"][row["doc_id"]], add_special_tokens=False).ids, 1], dtype="<u4")
        part = ids[row["start"] : row["start"] + row["length"]]
        assert (len(part), zlib.crc32(part.tobytes())) == (row["length"], row["ids_crc32"])
        assert ends[row["sequence_id"]] == row["offset"]
        ends[row["sequence_id"]] += row["length"]
    assert max(ends.values()) <= 4096 and {r["doc_id"] for r in docs.collect()} == set(kept["benchmark"])


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").lower()


def without_lines(texts):
    found = collections.Counter(k for t in texts.values() for k in {key(x) for x in t.split("\n")})
    return {
        i: "\n".join(x for x in t.split("\n") if not (key(x) and found[key(x)] >= 10)) for i, t in texts.items()
    }


def without_copies(texts):
    def runs(text):
        words = text.lower().split()
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}

    sets, first = {i: runs(t) for i, t in texts.items()}, {i: i for i in texts}
    for _ in range(3):
        for i in sorted(sets):
            for j in sets:
                if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    first[i] = first[j] = min(first[i], first[j])
    return {i: t for i, t in texts.items() if first[i] == i}


def test_the_whole_run_is_its_stages(spark, corpus):
    rows = corpus_pipeline.run(spark, corpus).collect()
    assert {row["doc_id"] for row in rows} and max(row["offset"] + row["length"] for row in rows) <= 4096
    assert not {190, 191, 192} & {row["doc_id"] for row in rows}


@needs_tables
def test_languages_of_rows_kept_out(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = language_id.identify(docs).filter("held_out AND lang IS NOT NULL AND lang_pred <> 'und'")
    right, sure, rows = found.agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg("score"), F.count("*")
    ).first()
    assert rows > 200 and right > 0.98
    assert abs(right - sure) < 0.03  # confidence is about as high as it should be


def test_temperature_lies_inside_its_range():
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 3, 400)
    logits = rng.normal(0, 1, (400, 3))
    logits[np.arange(400), labels] += 9  # all right
    for scale in (0.1, 1, 10):
        found = language_id.best_temperature(logits * scale, labels)
        assert language_id.TEMPERATURES[0] < found < language_id.TEMPERATURES[-1]


@needs_tables
def test_quality_of_rows_kept_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels"))
    found = quality.grade(docs, labels).filter("held_out").select("doc_id", "score")
    rows = found.join(labels, "doc_id").select("score", F.col("quality") == 1).collect()
    good, bad = ([s for s, q in rows if q is side] for side in (True, False))
    assert len(good) > 50 and len(bad) > 5
    above = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert above > 0.97
