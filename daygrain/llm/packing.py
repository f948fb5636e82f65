"""Packing documents into sequences of at most ``capacity`` tokens by hierarchical residual best fit."""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.spans import chunks, span_hashes
from daygrain.session import cut, ship

CAPACITY = 1024
END = 2
#: A bin with no more than this left is finished; the others go on to the next round.
NEARLY = 8
#: Items that one task packs at a time.
GROUP = 4096

SPACE, LETTER, NUMBER, OTHER, RARE = range(5)


def _kinds() -> np.ndarray:
    """For every code point of the first planes' common scripts its kind; RARE ones go to the library itself."""
    kinds = np.full(0x110000, RARE, np.uint8)
    for c in (*range(0x21, 0x7F), *range(0xA1, 0x250), *range(0x370, 0x530), *range(0x2010, 0x2028), *range(0x20A0, 0x20BF), *range(0x4E00, 0x9FA6)):
        first = unicodedata.category(chr(c))[0]
        kinds[c] = LETTER if first == "L" else NUMBER if first == "N" else OTHER if first in "PSM" else RARE
    kinds[[0x20, 0x0A, 0x0D, 0x09]] = SPACE
    return kinds


class Words:
    """Token ids of texts, encoding each different pre-token once.

    Byte-level BPE works inside pre-tokens, and most of them repeat. A direct-mapped table of fixed
    size remembers their ids; a pre-token that meets a taken place is encoded again. Texts with
    rare characters or special tokens are encoded as a whole.
    """

    SLOTS, MOST_IDS = 1 << 21, 1 << 24

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kinds = _kinds()
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.places = np.zeros((self.SLOTS, 2), np.int32)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as the tokenizer itself gives them."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for k, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[k] = self._whole(text)
            else:
                plain.append(k)
        text, points, offsets = self._joined(texts, plain)
        kind = self.kinds[points]
        if (kind == RARE).any():
            rare = np.unique(np.searchsorted(offsets, np.flatnonzero(kind == RARE), "right") - 1)
            for k in rare.tolist():
                out[plain[k]] = self._whole(texts[plain[k]])
            drop = set(rare.tolist())
            plain = [p for k, p in enumerate(plain) if k not in drop]
            text, points, offsets = self._joined(texts, plain)
            kind = self.kinds[points]
        starts = self._starts(points, kind, offsets)
        ends = np.append(starts[1:], len(points))
        flat, lengths = self._look_up(text, points, starts, ends)
        token_at = np.concatenate(([0], np.cumsum(lengths)))[np.searchsorted(starts, offsets)]
        for k, a, b in zip(plain, token_at[:-1].tolist(), token_at[1:].tolist()):
            out[k] = flat[a:b]
        return out

    @staticmethod
    def _joined(texts: list[str], rows: list[int]) -> tuple[str, np.ndarray, np.ndarray]:
        text = "".join([texts[k] for k in rows])
        offsets = np.concatenate(([0], np.cumsum([len(texts[k]) for k in rows], dtype=np.int64)))
        return text, np.frombuffer(text.encode("utf-32-le"), np.uint32), offsets

    @staticmethod
    def _starts(points: np.ndarray, kind: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pre-tokens start: runs of one kind, a single space going with the run that follows it."""
        n = len(points)
        if not n:
            return np.zeros(0, np.int64)
        first = np.zeros(n, bool)
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        start = first.copy()
        start[1:] |= kind[1:] != kind[:-1]
        space = kind == SPACE
        after = np.zeros(n, bool)
        after[1:] = space[:-1]
        heads = np.flatnonzero(start & ~first & ~space & after)
        start[heads - 1] = True
        start[heads] = points[heads - 1] != 32
        # Contractions ('s 't 'm 'd 're 've 'll) are split off where an apostrophe starts a pre-token.
        marks = np.flatnonzero((points == 39) & start)
        if len(marks):
            text, last = points, np.append(offsets[1:][np.diff(offsets) > 0], n)
            limit = last[np.searchsorted(last, marks, "right")]
            for a, end in zip(marks.tolist(), limit.tolist()):
                tail = "".join(map(chr, text[a + 1 : min(a + 3, end)]))
                size = 1 if tail[:1] in ("s", "t", "m", "d") and tail else 2 if tail in ("re", "ve", "ll") else 0
                if size:
                    start[a + 1] = False
                    if a + 1 + size < end:
                        start[a + 1 + size] = True
        return np.flatnonzero(start)

    def _look_up(self, text: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if self.used > self.MOST_IDS:
            self.clear()
        keys = span_hashes(points, starts, ends) | np.uint64(1)
        slots = (keys >> np.uint64(20)).astype(np.int64) & (self.SLOTS - 1)
        missing = np.flatnonzero(self.keys[slots] != keys)
        if len(missing):
            self._remember(text, keys, slots, starts, ends, missing)
        places = self.places[slots].astype(np.int64)
        lost = np.flatnonzero(self.keys[slots] != keys)
        if len(lost):  # pre-tokens of this call that meet in one place
            where, back = self._append(text, keys, starts, ends, lost)[1:]
            places[lost] = where[back]
        lengths = places[:, 1]
        moved = np.repeat(places[:, 0] - (np.cumsum(lengths) - lengths), lengths)
        return self.flat[moved + np.arange(len(moved))], lengths

    def _remember(self, text: str, keys: np.ndarray, slots: np.ndarray, starts: np.ndarray, ends: np.ndarray, missing: np.ndarray) -> None:
        new, where, _ = self._append(text, keys, starts, ends, missing)
        self.keys[slots[new]] = keys[new]
        self.places[slots[new]] = where

    def _append(self, text: str, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Encode the different pre-tokens of ``rows``: one row of each, their places, and which of them each row is."""
        _, one, back = np.unique(keys[rows], return_index=True, return_inverse=True)
        new = rows[one]
        found = self._encode([text[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
        sizes = np.array([len(x) for x in found], np.int64)
        total = int(sizes.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros(max(len(self.flat), total), np.uint32)))
        self.flat[self.used : self.used + total] = np.concatenate(found)
        where = np.stack((self.used + np.cumsum(sizes) - sizes, sizes), 1)
        self.used += total
        return new, where, back

    def _encode(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each pre-token. Those of a space and letters keep apart when joined, so one call encodes them all."""
        joined = [k for k, w in enumerate(words) if w[0] == " " and len(w) > 1 and w[1:].isalpha()]
        out: list[np.ndarray | None] = [None] * len(words)
        for at in range(0, len(joined), 2000):
            part = joined[at : at + 2000]
            encoding = self.tokenizer.encode("".join(words[k] for k in part), add_special_tokens=False)
            ids, number = np.array(encoding.ids, np.uint32), np.array(encoding.word_ids, np.int64)
            cuts = np.searchsorted(number, np.arange(len(part) + 1))
            for k, a, b in zip(part, cuts[:-1].tolist(), cuts[1:].tolist()):
                out[k] = ids[a:b]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, encoding in zip(rest, self.tokenizer.encode_batch_fast([words[k] for k in rest], add_special_tokens=False)):
            out[k] = np.array(encoding.ids, np.uint32)
        return out


_loaded: dict[str, Words] = {}


def _pieces(path: str, capacity: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _loaded.get(path) or _loaded.setdefault(path, Words(path))
        last = np.array([end], np.uint32)
        for batch in batches:
            column = batch.column("text")
            rows: list[tuple[int, int, int, int, int]] = []
            docs = batch.column("doc_id").to_pylist()
            for chunk in chunks(column):
                texts = [t or "" for t in column.slice(chunk.first, chunk.rows).to_pylist()]
                for doc, ids in zip(docs[chunk.first : chunk.first + chunk.rows], words.ids(texts)):
                    ids = np.concatenate((ids, last)).astype("<u4")
                    n = len(ids)
                    count = -(-n // capacity)
                    at = 0
                    for piece in range(count):
                        to = n - capacity * (count - 1 - piece)
                        rows.append((doc, piece, at, to - at, zlib.crc32(ids[at:to].data)))
                        at = to
            doc, *rest = map(list, zip(*rows)) if rows else ([] for _ in range(5))
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), *(pa.array(x, t) for x, t in zip(rest, types))], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return run


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each text's ids and ``end``, cut where longer than ``capacity``.

    All pieces but the first have ``capacity`` ids. Null text is empty text: the end alone.
    """
    ship(docs.sparkSession)
    kinds = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, capacity, end), kinds)


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Positions of the items in each bin, by falling size into the fullest bin that still has room."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_bins = 0  # bit k is set where a bin has room for k
    bins: list[list[int]] = []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = open_bins >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            number = room[left].pop()
            if not room[left]:
                open_bins &= ~(1 << left)
            bins[number].append(item)
            left -= size
        else:
            number, left = len(bins), capacity - size
            bins.append([item])
        if left:
            room[left].append(number)
            open_bins |= 1 << left
    return bins


def _packed(capacity: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["filled", "seed"], ascending=[False, True], kind="stable")
        sizes, members, seeds = group["filled"].to_numpy(), group["members"].tolist(), group["seed"].to_numpy()
        bins = best_fit(sizes, capacity)
        return pd.DataFrame(
            {
                "seed": [int(seeds[b].min()) for b in bins],
                "filled": [int(sizes[b].sum()) for b in bins],
                "members": [[m for k in b for m in members[k]] for b in bins],
            }
        )

    return run


PIECE = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>"


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, nearly: int = NEARLY) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Every round deals the open bins (at first: the pieces) to groups of about ``group`` and packs each
    by best fit. Nearly full bins are finished; the others are the items of the next round. Best fit
    leaves one bin of a group at most that is not more than half full, so these become fewer by the size of a
    group in each round; they are dealt among themselves, where any two fit together, and over few groups.
    The rounds end when one of them is left at most: only that one could still go into another bin.
    A bin has at most ``capacity`` members, a task about two groups at most: rows that are equal in
    everything are dealt apart by a stored row number. An empty input gives an empty result.
    """
    row = F.struct("doc_id", "piece", "start", "length", "ids_crc32").cast(PIECE)
    items = pieces.select(F.monotonically_increasing_id().alias("seed"), F.col("length").alias("filled"), F.array(row).alias("members"))
    kinds = f"seed bigint, filled bigint, members array<{PIECE}>"
    done = [items.where(F.col("filled") > capacity - nearly)]
    left = cut(items.where(F.col("filled") <= capacity - nearly))
    small = F.col("filled") * 2 <= capacity
    while True:
        count, n_small = left.agg(F.count("*"), F.count_if(small)).first()
        if n_small <= 1:
            done.append(left)
            break
        groups = F.when(small, -(-n_small // group)).otherwise(-(-count // group))
        key = F.pmod(F.xxhash64("seed", F.lit(len(done))), groups)
        packed = cut(left.groupBy(key.alias("part")).applyInPandas(_packed(capacity), kinds))
        done.append(packed.where(F.col("filled") > capacity - nearly))
        left = packed.where(F.col("filled") <= capacity - nearly)
    bins = done[0]
    for more in done[1:]:
        bins = bins.unionByName(more)
    numbered = bins.select(F.monotonically_increasing_id().alias("sequence_id"), "members")
    placed = numbered.select("sequence_id", "members", F.posexplode("members").alias("at", "m"))
    before = F.aggregate(F.slice("members", F.lit(1), F.col("at")), F.lit(0).cast("bigint"), lambda total, m: total + m["length"])
    return placed.select("m.*", "sequence_id", before.alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Each piece of each row of ``docs`` (doc_id, text; more columns are ignored), packed.

    Null and empty texts are a piece of one id. Rows that repeat, and rows without doc_id, are packed
    like others.
    """
    return pack(cut(token_pieces(docs, tokenizer, capacity, end)), capacity)
