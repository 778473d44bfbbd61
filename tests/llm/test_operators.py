"""The corpus operators against brute force, on small texts with all the odd cases."""

from __future__ import annotations

import base64
import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketmill.llm import (
    decontamination,
    exact_dedup,
    language_id,
    line_dedup,
    packing,
    quality,
    repeats,
    simhash,
    substring_dedup,
    suffix_dedup,
    warc,
)

PASSAGE = " ".join(f"word{i}" for i in range(60))
LINE = "  This line IS shared \t"
TEXTS = {
    1: f"start one {PASSAGE} end",
    2: f"other beginning {PASSAGE} and  end",
    3: None,
    4: "",
    5: " \t\n",
    6: "same text here",
    7: "same  text\there",
    8: "é" * 300 + " ünï " + "é" * 300,
    9: "a " * 3000,
    10: f"start one {PASSAGE} end",
    11: f"{PASSAGE} {PASSAGE}",
    12: "!!! 123",
    **{20 + i: f"own line {i}\n{LINE}\nlast {i}" for i in range(12)},
}
COLUMNS = "doc_id long, text string, lang string, n_lines string, score string, body string"


@pytest.fixture(scope="module")
def docs(spark):
    langs = ("en", "de", None)
    rows = [(i, t, langs[i % 3], "x", "y", "z") for i, t in TEXTS.items()]
    rows += [(None, "without an id", "en", None, None, None), (6, "same text here", "en", "", "", "")]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def by_id(df) -> dict:
    return {row["doc_id"]: row.asDict() for row in df.collect() if row["doc_id"] is not None}


def test_exact_groups(docs, empty):
    rows = exact_dedup.exact_groups(docs, digest_all=True).collect()
    assert len(rows) == len(TEXTS) + 2
    body = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in TEXTS.items()}
    for row in (r for r in rows if r["doc_id"] is not None):
        same = [i for i in body if body[i] == body[row["doc_id"]]]
        assert row["keep_id"] == min(same)
        assert row["text_sha256"] == hashlib.sha256(body[row["doc_id"]].encode()).hexdigest()
        assert row["group_size"] == len(same) + (body[row["doc_id"]] == "same text here")
    kept = collections.Counter(r["keep_id"] for r in rows if r["kept"])
    assert set(kept.values()) == {1}  # one row of each group, repeated rows included
    assert exact_dedup.exact_groups(empty).count() == 0


def test_line_dedup(docs, empty):
    found = by_id(line_dedup.drop_common_lines(docs))
    for i, text in TEXTS.items():
        lines = (text or "").split("\n")
        left = [x for x in lines if x.strip(" \t") != LINE.strip(" \t")]
        assert found[i]["text"] == "\n".join(left)
        assert (found[i]["n_lines"], found[i]["n_dropped"]) == (len(lines), len(lines) - len(left))
    assert line_dedup.drop_common_lines(empty).count() == 0


def test_perfect_hash_is_minimal():
    values = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64))
    table = line_dedup.PerfectHash.build(values)
    assert sorted(table.index(values).tolist()) == list(range(len(values)))


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.tokenised_pieces(docs, path, capacity=64)
    rows = packing.pack(pieces, capacity=64).collect()
    plain = Tokenizer.from_file(path)
    for i, text in TEXTS.items():
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        own = sorted({(r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == i})
        cut = [ids[s : s + 64] for s in range(0, len(ids), 64)]
        want = [(64 * k, len(part), zlib.crc32(part.tobytes())) for k, part in enumerate(cut)]
        assert own == want
    check_gapless(rows, 64)
    assert packing.pack(packing.tokenised_pieces(empty, path)).count() == 0


def test_encoder_agrees_with_the_tokenizer(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_PARTS", 50)
    monkeypatch.setattr(packing, "SLICE", 40)
    letters = [*"abcxyzABC '`stlrevemd0123²½ªºßÀÿ÷×\t\n\r\x0b\x0c\x85\xa0\xad\x00\x1c\x7f.,!?<|>-_éñİıſK中文😀",
               "e\u0301", "\u200b", "<|endoftext|>", "'s", "'LL", "  ", "\n\n"]
    drawn = np.random.default_rng(7)
    texts = ["".join(drawn.choice(letters, n)) for n in drawn.integers(0, 30, 3000)]
    texts += ["".join(drawn.choice(letters, 5000)), "plain words only " * 200, "x" * 300]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):  # the second has other rules
        path = public_tokenizers.path(name)
        plain, encode = Tokenizer.from_file(path), packing.TextEncoder(path)
        assert encode.known_rules == (name == "word_bpe_49k.json")
        for text in texts:
            assert encode(text.encode()).tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(encode.parts) <= 50 and len(encode.parts.older) <= 50


def check_gapless(rows, capacity):
    bins = collections.defaultdict(list)
    for row in rows:
        bins[row["sequence_id"]].append((row["offset"], row["length"]))
    for held in bins.values():
        ends = 0
        for offset, length in sorted(held):
            assert offset == ends
            ends += length
        assert ends <= capacity
    return len(bins)


def test_packing_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "PARTITION_PIECES", 40)
    monkeypatch.setattr(packing, "FAN_IN", 2)
    lengths = np.random.default_rng(0).integers(1, 100, 700).tolist()
    pieces = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long")
    rows = packing.pack(pieces, 100).collect()
    assert sorted(r["length"] for r in rows) == sorted(lengths)
    at_once = len(packing.best_fit(np.array(lengths), 100)[2])
    assert at_once <= check_gapless(rows, 100) <= 1.1 * at_once
    halves = spark.createDataFrame([(i, 51) for i in range(300)], "doc_id long, length long")
    assert check_gapless(packing.pack(halves, 100).collect(), 100) == 300


def test_simhash(docs, empty):
    found = by_id(simhash.near_duplicates(docs))
    prints = {i: simhash.fingerprint(simhash.shingle_hashes((t or "").encode(), 3)) for i, t in TEXTS.items()}
    assert {i: found[i]["fingerprint"] for i in TEXTS} == prints
    label = {i: i for i in TEXTS}
    for _ in TEXTS:
        for a in TEXTS:
            for b in TEXTS:
                if ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 2:
                    label[a] = label[b] = min(label[a], label[b])
    assert {i: found[i]["component"] for i in TEXTS} == label
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each(docs, empty):
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    ids = {row["doc_id"] for row in left.collect()}
    # 2 and 11 share 56 of 63 runs with 1; 4 and 5 are as empty as 3; 7 and 10 are copies.
    assert ids == {1, 3, 6, 8, 9, 12, None, *range(20, 32)}
    assert simhash.one_of_each(empty).count() == 0


def test_similar_documents_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 8)
    monkeypatch.setattr(simhash, "TILE_RUNS", 500)
    rng = np.random.default_rng(5)
    texts = {}
    for size in (1, 4, 5, 9, 40, 41, 50, 200, 260):
        base = [f"w{n}" for n in rng.integers(0, 5000, size)]
        for _ in range(4):
            changed = list(base)
            for place in rng.integers(0, size, size // 60):
                changed[place] = f"v{rng.integers(0, 5000)}"
            texts[len(texts)] = " ".join(changed[: size - int(rng.integers(0, 1 + size // 12))])
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    # At radius 64 every pair is a candidate, so the sizes alone must not lose one.
    found = by_id(simhash.similar_documents(rows, radius=64))
    runs = {i: set(simhash.run_set(text.encode(), 5).tolist()) for i, text in texts.items()}
    label = {i: i for i in texts}
    for _ in texts:
        for a in texts:
            for b in texts:
                if len(runs[a] & runs[b]) >= 0.8 * len(runs[a] | runs[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert len(set(label.values())) < len(texts)
    assert {i: found[i]["component"] for i in texts} == label


def test_near_copies_with_repeated_lines_are_found(spark):
    rng = np.random.default_rng(3)
    texts = {}
    for i in range(30):
        words = [f"w{n}" for n in rng.integers(0, 5000, 100)]
        texts[2 * i] = " ".join(words)
        texts[2 * i + 1] = " ".join(words + 20 * words[-12:])
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    left = {row["doc_id"] for row in simhash.one_of_each(rows).collect()}
    for i in range(30):
        one, two = (set(simhash.run_set(texts[k].encode(), 5).tolist()) for k in (2 * i, 2 * i + 1))
        assert len(one & two) >= 0.8 * len(one | two)
    assert left == {2 * i for i in range(30)}


def test_texts_at_the_least_similarity_are_candidates(spark):
    rng = np.random.default_rng(11)
    texts, want = {}, set()
    for i in range(150):
        size = int(rng.integers(60, 300))
        words = [f"w{n}" for n in rng.integers(0, 50_000, size)]
        runs = size - 4
        foreign = [f"v{n}" for n in rng.integers(0, 50_000, runs // 4)]
        other = (
            words + foreign,  # runs / (runs + foreign) is just 0.8 or more
            words[: size - runs // 5],
            words[: size // 2] + foreign[: max(1, runs // 9 - 4)] + words[size // 2 + max(1, runs // 9 - 4) :],
        )[i % 3]
        texts[2 * i], texts[2 * i + 1] = " ".join(words), " ".join(other)
        want.add(2 * i)
    for i in range(150, 160):  # nine words against the same eight: four of five runs
        words = [f"w{n}" for n in rng.integers(0, 50_000, 9)]
        texts[2 * i], texts[2 * i + 1] = " ".join(words), " ".join(words[:8])
        want.add(2 * i)
    for i in want:
        one, two = (set(simhash.run_set(texts[k].encode(), 5).tolist()) for k in (i, i + 1))
        assert len(one & two) >= 0.8 * len(one | two)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert {row["doc_id"] for row in simhash.one_of_each(rows).collect()} == want


def test_chance_of_a_missed_pair():
    assert simhash.differing_share(4, 0, 1) == 0.1875
    hashes = np.random.default_rng(2).integers(-(2**63), 2**63, (4000, 5))
    apart = [
        np.bitwise_count((simhash.set_print(x[:4]) ^ simhash.set_print(x)).view(np.uint64)).sum()
        for x in hashes
    ]
    assert abs(np.mean(apart) / 256 - 0.1875) < 0.002
    assert np.max(apart) <= simhash.radius_for(0.8) <= 80


def test_texts_that_share_an_id_are_judged_one_by_one(spark):
    words = [[f"{kind}{n}" for n in range(50)] for kind in "abc"]
    rows = [(3, " ".join(words[0])), (7, " ".join([*words[0], "more"])), (7, " ".join(words[1])),
            (9, " ".join([*words[1], "more"])), (7, " ".join(words[2]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {(row["doc_id"], row["text"]) for row in simhash.one_of_each(docs).collect()}
    assert left == {rows[0], rows[2], rows[4]}


def test_one_of_repeated_rows_stays(spark):
    text = " ".join(f"w{n}" for n in range(30))
    rows = [(1, text, k) for k in range(5)] + [(None, "without an id and alone", k) for k in range(5)]
    rows += [(2, "own words of the second", 0), (2, "own words of the  second", 1), (None, text, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int").repartition(3)
    left = [(row["doc_id"], row["text"].split()[0]) for row in simhash.one_of_each(docs).collect()]
    assert sorted(left, key=str) == [(1, "w0"), (2, "own"), (None, "without")]


def test_sizes_that_may_link_are_in_adjacent_bands(spark):
    sizes = spark.range(0, 3000).select(
        simhash.band_of(F.col("id"), 0.8).alias("small"),
        simhash.band_of(F.floor(F.col("id") * 5 / 4), 0.8).alias("large"),
    )
    assert sizes.filter("large - small NOT IN (0, 1)").count() == 0


@pytest.mark.parametrize("blocks", [1, 2, 4, 8, 16])
def test_no_link_lies_beyond_the_cells(blocks):
    rng = np.random.default_rng(blocks)
    steps = set(simhash.offsets(blocks, 2))
    width, base = 64 // blocks, 128 if blocks <= 8 else 8

    def cell(x):
        part = [(x >> (i * width)) & ((1 << width) - 1) for i in range(blocks)]
        return sum(p.bit_count() * base**i for i, p in enumerate(part))

    for _ in range(300):
        x = int(rng.integers(0, 2**63))
        y = x ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64)))
        assert abs(cell(x) - cell(y)) in steps


@pytest.mark.parametrize(
    "drop, module, name",
    [
        (substring_dedup.drop_repeated_words, substring_dedup, "shard_ranges"),
        (suffix_dedup.drop_repeated_bytes, suffix_dedup, "equal_suffixes"),
    ],
)
@pytest.mark.parametrize("hot", [0, 20_000])
def test_repeats_are_decided_by_the_index_and_the_suffixes(docs, monkeypatch, drop, module, name, hot):
    """Without the index, or the sorted suffixes, nothing is removed, whole copies included."""
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    assert drop(docs).agg(F.sum("n_removed")).first()[0] > 0
    if name == "shard_ranges":
        none = pa.schema([("s1", pa.int64()), ("s2", pa.int64()), ("again", repeats.RANGE_LISTS),
                          ("later", repeats.RANGE_LISTS)]).empty_table()
        monkeypatch.setattr(module, name, lambda rows, window: none)
    else:
        monkeypatch.setattr(module, name, lambda text, places, *rest: np.zeros(len(places), dtype=bool))
    assert drop(docs).agg(F.sum("n_removed")).first()[0] == 0


def test_repeated_rows_share_their_ranges(spark):
    rows = [(None if i % 2 else 7, PASSAGE) for i in range(40)] + [(1, f"x {PASSAGE}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    units = substring_dedup.Words(20, 6)
    found = repeats.removed_units(docs, units, substring_dedup.compare_in_shards(20),
                                  substring_dedup.word_windows(20), True, "doc_id", "text").collect()
    assert {(r["doc_id"], r["row"]) for r in found} == {(r["doc_id"], r["row"]) for r in found[:2]}
    assert max(len(r["ranges"]) for r in found) <= 60
    gone = {r["n_removed"] for r in substring_dedup.drop_repeated_words(docs).filter("doc_id = 7").collect()}
    assert gone == {60}


@pytest.mark.parametrize("hot", [0, 2, 20_000])
def test_repeated_words(docs, empty, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    found = by_id(substring_dedup.drop_repeated_words(docs))
    seen = {}
    for i in sorted(TEXTS):
        words = (TEXTS[i] or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            run = tuple(words[s : s + 20])
            if seen.setdefault(run, (i, s)) != (i, s):
                gone[s : s + 20] = [True] * 20
        left = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        assert (found[i]["text"], found[i]["n_words"], found[i]["n_removed"]) == (
            left, len(words), sum(gone))
    assert substring_dedup.drop_repeated_words(empty).count() == 0


@pytest.mark.parametrize("hot", [0, 2, 20_000])
def test_repeated_bytes(docs, empty, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_SEGMENTS", hot)
    found = by_id(suffix_dedup.drop_repeated_bytes(docs))
    data = {i: (t or "").encode() for i, t in TEXTS.items()}
    count = collections.Counter(b[s : s + 200] for b in data.values() for s in range(len(b) - 199))
    for i, b in data.items():
        gone = np.zeros(len(b) + 1, dtype=bool)
        for s in range(len(b) - 199):
            gone[s : s + 200] |= count[b[s : s + 200]] > 1
        left = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        spans = int(((gone[:-1]) & ~np.append(False, gone[:-2])).sum()) if len(b) else 0
        row = found[i]
        assert (bytes(row["body"]), row["n_bytes"], row["n_removed"], row["n_spans"]) == (
            left, len(b), int(gone.sum()), spans)
    assert suffix_dedup.drop_repeated_bytes(empty).count() == 0


def test_decontamination(spark, docs, empty):
    items = [(1, " ".join(f"word{i}" for i in range(10, 40))), (2, "Without an ID"), (3, None),
             (4, ""), (None, PASSAGE), (5, " ".join(f"other{i}" for i in range(30)))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contaminated(docs, benchmark).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in found}
    assert pairs == {(1, 1), (2, 1), (10, 1), (11, 1), (None, 2)}
    left = decontamination.without_benchmark(docs, benchmark)
    assert left.columns == docs.columns and left.count() == docs.count() - 5
    assert decontamination.contaminated(empty, benchmark).count() == 0
    assert decontamination.contaminated(docs, benchmark.limit(0)).count() == 0


def test_language_and_quality(spark, docs, empty):
    rows = language_id.identify(docs).collect()
    assert len(rows) == docs.count()
    for row in rows:
        known = any(map(str.isalpha, row["text"] or ""))
        assert row["lang_pred"] in (("en", "de") if known else ("und",))
        assert 0 <= row["score"] <= 1
    assert {r["lang_pred"] for r in language_id.identify(docs.withColumn("lang", docs.lang.substr(9, 1)).na.fill("")).collect()} >= {"und"}
    assert language_id.identify(empty).count() == 0
    labels = spark.createDataFrame([(i, i % 2) for i in TEXTS] + [(1, None), (None, 1)], "doc_id long, quality int")
    graded = quality.grade(docs, labels).collect()
    assert len(graded) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in graded)
    assert {r["score"] for r in quality.grade(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.grade(empty, labels).count() == 0


def test_copies_take_one_place_of_a_language(spark, monkeypatch):
    texts = [f"text number {i}" for i in range(40)]
    rows = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    first = rows.orderBy(F.xxhash64("text")).first()["text"]
    copies = rows.unionByName(spark.createDataFrame([(first, "en")] * 100, rows.schema))
    taken, features = [], language_id.sample_features

    def counted(sample, grams):
        taken.append(sorted(row["text"] for row in sample.collect()))
        return features(sample, grams)

    monkeypatch.setattr(language_id, "sample_features", counted)
    for learned in (rows, copies):
        language_id.fit_languages(learned, per_language=20)
    assert len(set(taken[0])) == 20 and taken[0] == taken[1]


def test_warc_round_trip(spark):
    body = "<p>x\r\n\r\ny</p>"
    rows = [(1, "http://a", body, 0), (2, None, body, 0), (3, "u\r\nv", None, 0), (4, "", "", 0),
            (5, "w", "é" * 5000, 0), (None, "n", "null id", 0), (2, "again", body, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, bytes int")
    found = warc.round_trip(pages).collect()
    assert len(found) == len(rows)
    html = {r[0]: (r[2] or "").encode() for r in rows}
    for row in found:
        payload = html[row["page_id"]]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (row["payload_bytes"], row["payload_digest"]) == (len(payload), digest)
        assert row["payload"] is None or bytes(row["payload"]) == payload
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in found}
    assert {(1, "revisit", 2), (2, "response", None), (3, "revisit", 4), (4, "response", None)} <= kinds
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_records_are_read_by_as_many_tasks_as_archives(spark):
    pages = spark.range(0, 400, 1, 5).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.concat(F.lit("page "), F.col("id").cast("string")).alias("html"),
    )
    found = warc.round_trip(pages)
    per_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) == 5 and sum(per_task) == 400 and max(per_task) < 160


def test_quality_learns_from_one_row_of_an_id(spark, monkeypatch):
    rows = [(i, f"good text of number {i} and more words") for i in range(20)]
    rows += [(3, f"the same id again {k}") for k in range(300)] + [(None, "no id")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = [(i, 1) for i in range(0, 20, 2)] + [(i, 1) for i in range(1000, 1200)] + [(3, 0)]
    given = spark.createDataFrame(labels, "doc_id long, quality int")
    sizes = []

    def counted(sample, grams):
        sizes.append({r["label"]: r["count"] for r in sample.groupBy("label").count().collect()})
        return []

    monkeypatch.setattr(quality, "sample_features", counted)
    quality.fit_quality(docs, given, per_side=15)
    assert sizes == [{1: 10, 0: 15}]  # labels of other tables take no places of the sample


def test_tiles_of_set_prints_by_population_counts(spark):
    """Tiles hold like population counts, and no pair within the radius is skipped."""
    chosen = random.Random(8)
    bits = simhash.PRINT_WORDS * 64

    def words(value):
        cut = [value >> 64 * k & (1 << 64) - 1 for k in range(simhash.PRINT_WORDS)]
        return [w - (1 << 64) if w >> 63 else w for w in cut]

    values = []
    for ones in range(0, bits + 1, 16):
        value = sum(1 << b for b in chosen.sample(range(bits), ones))
        near = value
        for b in chosen.sample(range(bits), 12):
            near ^= 1 << b
        values += [value, near]
    nodes = spark.createDataFrame(
        [(words(v), i, chosen.choice([40, 46, 50])) for i, v in enumerate(values)],
        "prints array<bigint>, node long, size long",
    )
    for radius in (3, 12, 80):
        tiles = nodes.select("node", simhash.set_tile(simhash.band_of(F.col("size"), 0.8), F.col("prints"), radius).alias("tile"))
        assert tiles.select("tile").distinct().count() > 3
        found = {frozenset(r) for r in simhash.print_links(nodes, radius, 0.8).collect()}
        size = {r["node"]: r["size"] for r in nodes.collect()}
        label = list(range(len(values)))
        for a, b in itertools.combinations(label[:], 2):
            alike = min(size[a], size[b]) >= 0.8 * max(size[a], size[b])
            if alike and (values[a] ^ values[b]).bit_count() <= radius:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
        linked = list(range(len(values)))
        for a, b in found:
            old, new = max(linked[a], linked[b]), min(linked[a], linked[b])
            linked = [new if x == old else x for x in linked]
        assert linked == label
