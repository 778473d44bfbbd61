"""Best-fit packing of tokenised documents by hierarchical residual packing.

Documents are tokenised where they are read; only lengths and checksums travel. Pieces are
dealt to partitions of bounded size and packed best-fit, longest first. Bins that are nearly
full are final. The others rise as items to a node of a merge tree, are packed best-fit
again, and so on to the root.

Of two bins that are left at a node at least one is over half full, else they would have
been joined. So each partition leaves one bin that others can take in at most, and of the
bins over half full at most as many can still take one in as there are partitions. A node
hands up that many, the emptiest, and all its smaller ones: a bin that stays behind could
not have saved a sequence. A node therefore never holds more than its fan-in times the
number of partitions, also if every document is just over half a sequence long.
"""

from __future__ import annotations

import json
import math
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import spare, stored, whole_text

CAPACITY = 4096
END = 1  # the id that closes a document
PARTITION_PIECES = 100_000
FAN_IN = 8
NEARLY_FULL = 0.98
KEPT_PARTS = 100_000  # in each of two generations
LONGEST_KEPT = 32
SLICE = 1 << 20  # characters that are cut into parts at a time
# How the tokenizer prepares text and cuts it into parts.
RULES = [
    {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
]
# The same parts among plain characters: the letters and the digits of lower-case Latin-1.
LETTERS, DIGITS = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
PARTS = re.compile(rf"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{DIGITS}]|[^\s{LETTERS}{DIGITS}]+")
ODD = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]")
BREAK = re.compile(r"[ \n]")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it shows, else one from 256 on."""
    shows = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (byte for byte in range(256) if byte not in shows)
    return {byte: chr(byte) for byte in shows} | {
        byte: chr(256 + i) for i, byte in enumerate(hidden)
    }


class PartIds(dict):
    """Ids of parts, looked up once: of two generations the older goes when the newer is full.

    Parts over LONGEST_KEPT characters are not kept, which bounds the bytes.
    """

    def __init__(self, look_up: Callable[[str], bytes]):
        super().__init__()
        self.look_up = look_up
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self.look_up(part)
        if len(part) <= LONGEST_KEPT:
            if len(self) >= KEPT_PARTS:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids


class TextEncoder:
    """Text to ids, the same as the tokenizer's, with the ids of usual parts kept.

    A tokenizer with `RULES` puts text into NFC and lower case and drops what is between its
    parts, so the ids of a text are those of its parts, one after the other. Texts of plain
    Latin-1 characters are cut into parts here. Of others that is done word by word, and
    words with further characters, or that may hold a special token, are left to the
    tokenizer whole. So are all texts if the tokenizer has other rules.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.parts = PartIds(self.part)
        steps = (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)
        rules = [step and json.loads(step.__getstate__()) for step in steps]
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.known_rules = rules == RULES and all(x.startswith("<|") for x in special)

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def part(self, part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return packed([token.id for token in self.model.tokenize(shown)])

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, PARTS.findall(text.lower())))

    def slice(self, text: str) -> bytes:
        if not odd(text):
            return self.plain(text)
        words = text.replace("\n", " ").split(" ")
        return b"".join(self.whole(w) if odd(w) else self.plain(w) for w in words)

    def __call__(self, text: bytes) -> np.ndarray:
        decoded = text.decode()
        found = map(self.slice, slices(decoded)) if self.known_rules else [self.whole(decoded)]
        return np.frombuffer(b"".join(found), dtype="<u4")


def odd(text: str) -> bool:
    return "<|" in text or ODD.search(text) is not None


def slices(text: str) -> Iterator[str]:
    """Slices of `text` that end at a blank or a line break."""
    start = 0
    while start < len(text):
        end = BREAK.search(text, start + SLICE)
        stop = end.end() if end else len(text)
        yield text[start:stop]
        start = stop


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def tokenised_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): a row for each piece of a document.

    A document is its ids and the id 1; only a longer one than `capacity` is cut, into
    pieces of that length, the last of which may be shorter. Null text counts as empty.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = TextEncoder(tokenizer_path)  # of this task, and gone with it
        for batch in batches:
            rows: list[tuple] = []
            kept: list[np.ndarray] = []
            texts = batch.column(1).cast(pa.large_binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                ids = np.append(encode(text.as_py()), np.uint32(END)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
                    if with_ids:
                        kept.append(part.astype(np.int32))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    texts = docs.select(F.col(f"`{id_col}`").cast("long"), whole_text(text_col))
    return texts.mapInArrow(pieces, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each item, longest items first, and the fill of the bins.

    An item goes to the fullest bin that can take it. Bins are kept by the room they have
    left; one whole number has a bit for each room that some bin has.
    """
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    fill: list[int] = []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            chosen = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            chosen, room = len(fill), capacity
            fill.append(0)
        bins[item], offsets[item] = chosen, fill[chosen]
        fill[chosen] += length
        left = room - length
        if left:
            with_room[left].append(chosen)
            rooms |= 1 << left
    return bins, offsets, fill


def rising(fill: np.ndarray, capacity: int, partitions: int) -> np.ndarray:
    """Bins that can still save a sequence elsewhere."""
    open_ = fill < NEARLY_FULL * capacity
    small = open_ & (2 * fill <= capacity)
    large = np.flatnonzero(open_ & ~small)
    chosen = large[np.argsort(fill[large], kind="stable")[:partitions]]
    small[chosen] = True
    return small


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with sequence_id and offset: whole pieces, gapless, at most `capacity` long.

    Needs `length` from 1 to `capacity`, no null; other columns are passed on, but for
    sequence_id and offset, which are replaced. Rows that are equal are packed each.
    """
    items = stored(pieces.drop("sequence_id", "offset"), "pieces")
    partitions = max(1, math.ceil(items.count() / PARTITION_PIECES))
    columns = [f"`{name}`" for name in items.columns]
    mixed = F.pmod(F.xxhash64(*columns), F.lit(partitions)).cast("int")
    # Adjacent numbers for equal rows: many copies of one row spread like different rows.
    spread = F.pmod(mixed + F.monotonically_increasing_id(), F.lit(partitions)).cast("int")
    part_, fill_, rises_, home, shift = spare(items, "_part", "_fill", "_rises", "_home", "_shift")
    dealt = items.withColumn(part_, spread)

    def leaf(rows: pd.DataFrame) -> pd.DataFrame:
        bins, offsets, fill = best_fit(rows["length"].to_numpy(np.int64), capacity)
        fills = np.array(fill, dtype=np.int64)
        part = int(rows[part_].iloc[0])
        rows["sequence_id"] = (part << 32) + bins
        rows["offset"] = offsets
        rows[fill_] = fills[bins]
        rows[rises_] = rising(fills, capacity, partitions)[bins]
        return rows.drop(columns=part_)

    schema = items.schema.add("sequence_id", "long").add("offset", "long")
    schema = schema.add(fill_, "long").add(rises_, "boolean")
    packed = stored(dealt.groupBy(part_).applyInPandas(leaf, schema), "packed")
    risen = packed.filter(F.col(rises_))
    level = risen.select("sequence_id", F.col(fill_).alias("fill")).distinct()
    level = level.withColumns({"node": F.shiftright("sequence_id", 32), "home": F.col("sequence_id"),
                               "shift": F.lit(0).cast("long"), "rises": F.lit(True)})
    moved = merged(level, partitions, capacity).toDF("sequence_id", home, shift)
    placed = packed.join(moved, "sequence_id", "left")
    return placed.withColumns(
        {
            "sequence_id": F.coalesce(home, "sequence_id"),
            "offset": F.col("offset") + F.coalesce(shift, F.lit(0)),
        }
    ).select(*columns, "sequence_id", "offset")


def merged(level: DataFrame, partitions: int, capacity: int) -> DataFrame:
    """sequence_id, home, shift: where the bins that rose ended.

    A round has a row for each first bin: its present bin (`home`), its place there
    (`shift`), that bin's `fill` and tree `node`, and whether it rises on.
    """
    schema = level.schema

    def node(rows: pd.DataFrame) -> pd.DataFrame:
        homes = rows.drop_duplicates("home")
        # The fullest is placed first, so each bin keeps the name of its first item.
        bins, offsets, fill = best_fit(homes["fill"].to_numpy(np.int64), capacity)
        first = {b: h for b, h, o in zip(bins, homes["home"], offsets, strict=True) if o == 0}
        fills = np.array(fill, dtype=np.int64)
        up = rising(fills, capacity, partitions)
        at = dict(zip(homes["home"], zip(bins, offsets, strict=True), strict=True))
        new = [at[h] for h in rows["home"]]
        rows["shift"] = rows["shift"].to_numpy() + np.array([o for _, o in new], dtype=np.int64)
        rows["home"] = [first[b] for b, _ in new]
        rows["fill"] = [fills[b] for b, _ in new]
        rows["rises"] = [bool(up[b]) for b, _ in new]
        return rows

    width = partitions
    done = None
    while width > 1:
        width = math.ceil(width / FAN_IN)
        level = level.withColumn("node", F.floor(F.col("node") / FAN_IN))
        level = stored(level.groupBy("node").applyInPandas(node, schema), "merged")
        ended = level.filter("NOT rises")
        done = ended if done is None else done.unionByName(ended)
        level = level.filter("rises")
    every = level if done is None else done.unionByName(level)
    return every.select("sequence_id", "home", "shift")
