"""Best-fit packing by a configuration linear program over the length histogram.

Pieces of at most `capacity` tokens are packed into as few sequences as possible. The driver sees their histogram only
(one row per length). Multiplicative weights solve the program "each length is covered as often as it occurs" over all
configurations (multisets of lengths that fit a sequence): lengths that lag behind the others rise in price, and a
knapsack dynamic program prices, for each length, the best configuration that holds it. The solution is rounded, what
is left is solved again, and the few pieces that remain are packed by best fit, longest first, with equal pieces handled
together. On log-normal lengths more than 90 % of all sequences stem from the program (tested). The plan says which
ranks among the pieces of one length go to which sequences, and every piece finds its place from its own rank.

Defined results: a null text is empty and packs its closing id alone; longer documents are cut at the capacity and
only they; repeated rows are packed as often as they occur; rows with a null id are packed like others; empty tables give
no rows; other columns are not read. A very long text is tokenized in one task.
"""

from __future__ import annotations

import bisect
import os
import re
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Stored, in_parts

# -- tokens -----------------------------------------------------------------------------------------------------------

_LOW = [chr(i) for i in range(0x180)]
_LETTERS = "".join(re.escape(c) for c in _LOW if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(re.escape(c) for c in _LOW if unicodedata.category(c)[0] == "N")
_SPACES = "\t\n\v\f\r \x85\xa0"
#: The splitting rule of the tokenizer for characters below U+0180; texts with others go through the library whole.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACES}{_LETTERS}{_NUMBERS}]+")
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-įı-ſ]*")


class WordTokens:
    """Ids of texts: words, and runs between white space, are encoded by the library once and then remembered, up to `most`."""

    def __init__(self, tokenizer_file: str, most: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        ends = [i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends_word[ends] = True
        self.known: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}
        self.most = most

    def _alone(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        ids = np.array(self.tokenizer.encode(" ".join(new), add_special_tokens=False).ids, dtype="<u4")
        stops = np.flatnonzero(self.ends_word[ids]) + 1
        if len(stops) != len(new):  # not expected; each word alone is always right
            for w in new:
                self.known[w] = self._alone(w)
            return
        raw, at = ids.tobytes(), 0
        for w, stop in zip(new, (4 * stops).tolist(), strict=True):
            self.known[w] = raw[at:stop]
            at = stop

    def encode(self, texts: list[str]) -> list[bytes]:
        """The little-endian unsigned 32-bit ids of each text."""
        if len(self.known) + len(self.runs) > self.most:
            self.known, self.runs = {}, {}
        split = [None if "<|" in t or not _PLAIN.fullmatch(t) else t.lower().split() for t in texts]
        new = set().union(*(x for x in split if x)).difference(self.runs)
        if new:
            parts = {run: _SPLIT.findall(run) for run in new}
            words = list(set().union(*parts.values()).difference(self.known))
            # contractions and symbols could join what stands beside them: they are encoded alone
            for w in words:
                if not w[0].isalpha():
                    self.known[w] = self._alone(w)
            plain = [w for w in words if w[0].isalpha()]
            for i in range(0, len(plain), 2000):
                self._learn(plain[i : i + 2000])
            get = self.known.__getitem__
            for run, held in parts.items():
                self.runs[run] = b"".join(map(get, held))
        get = self.runs.__getitem__
        return [self._alone(t) if runs is None else b"".join(map(get, runs)) for t, runs in zip(texts, split, strict=True)]


@lru_cache(maxsize=2)
def word_tokens(tokenizer_file: str) -> WordTokens:
    return WordTokens(tokenizer_file)


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of the documents' tokens and a closing id, cut at the capacity."""

    def cut(batches):
        encoder = word_tokens(tokenizer_file)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for part in in_parts(batch, text_col):
                rows, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(encoder.encode(pc.fill_null(part.column(text_col), "").to_pylist())):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        held = ids[at : at + 4 * capacity]
                        rows.append(i), piece.append(k), start.append(at // 4), length.append(len(held) // 4), crc.append(zlib.crc32(held))
                yield pa.RecordBatch.from_arrays(
                    [part.column(id_col).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(cut, f"id {kind}, piece int, start long, length long, ids_crc32 long")


# -- the plan ---------------------------------------------------------------------------------------------------------


def price(lengths: np.ndarray, worth: np.ndarray, liking: np.ndarray, capacity: int, slack: float, random: np.random.Generator) -> list[int]:
    """pick[c]: the length to take where room for c tokens is left, 0 to leave one token empty.

    The knapsack's dynamic program over the lengths (ascending) and their prices `worth`. Of the lengths that come within
    `slack` of the best, one is drawn by `liking` (a logarithm), so that different rooms are filled with different lengths.
    """
    best, pick = np.zeros(capacity + 1), [0] * (capacity + 1)
    noise = random.gumbel(size=capacity + len(lengths))
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for c in range(1, capacity + 1):
        n = upto[c]
        best[c] = best[c - 1]
        if n:
            total = best[c - lengths[:n]] + worth[:n]
            top = total.max()
            if top >= best[c]:
                at = c * 677 % capacity
                k = int(np.where(total >= top - slack, liking[:n] + noise[at : at + n], -np.inf).argmax())
                best[c], pick[c] = total[k], int(lengths[k])
    return pick


def configurations(counts: dict[int, int], capacity: int, random: np.random.Generator, steps: int = 16, rate: float = 0.02, slack: float = 0.5, most: int = 600) -> list[tuple[dict[int, int], float]]:
    """A solution of the program "every length is covered as often as it occurs": configurations and how often each is taken.

    Each step prices every open length by the dynamic program: the best configuration that holds it, which is taken as
    often as the scarcest of its lengths lacks. Prices begin in proportion to the lengths (the dual of a perfect packing)
    and are multiplied down where more of a length is covered than of the others, up where less. A step's knapsack is
    filled from `most` lengths drawn by what they lack; every length can be the one that it is filled for.
    """
    need = np.zeros(capacity + 1)
    need[list(counts)] = list(counts.values())
    lengths, weights, lack, out = np.flatnonzero(need), np.ones(capacity + 1), need.tolist(), []
    for _ in range(steps):
        now = np.array(lack)
        open_ = lengths[now[lengths] > 1e-9]
        if not len(open_):
            break
        fill = open_
        if len(fill) > most:
            fill = np.sort(open_[np.argpartition(-np.log(now[open_]) - random.gumbel(size=len(open_)), most)[:most]])
        pick = price(fill, weights[fill] * fill, np.log(now[fill] * fill), capacity, slack, random)
        for first in open_[::-1].tolist():
            if lack[first] <= 1e-9:
                continue
            held, left = {first: 1}, capacity - first
            while left:
                k = pick[left]
                if k:
                    held[k] = held.get(k, 0) + 1
                left -= k or 1
            x = min(lack[k] / m for k, m in held.items())
            if x > 1e-9:
                out.append((held, x))
                for k, m in held.items():
                    lack[k] -= m * x
        covered = 1 - np.divide(lack, need, out=np.ones_like(need), where=need > 0)
        weights = np.clip(weights * np.exp(-rate * (covered - covered[lengths].mean())), 0.9, 1.1)
    return out


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first, over (length, count): sequences filled alike stay together as (contents, how many)."""
    room: dict[int, list[tuple[dict[int, int], int]]] = {}
    done: list[tuple[dict[int, int], int]] = []
    smallest = min(counts, default=0)
    spaces: list[int] = []

    def keep(held: dict[int, int], n: int, left: int) -> None:
        if left < smallest:
            done.append((held, n))
            return
        if left not in room:
            bisect.insort(spaces, left)
        room.setdefault(left, []).append((held, n))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect.bisect_left(spaces, length)
            if at == len(spaces):
                fit = capacity // length
                if n // fit:
                    keep({length: fit}, n // fit, capacity - fit * length)
                if n % fit:
                    keep({length: n % fit}, 1, capacity - n % fit * length)
                break
            left = spaces[at]
            held, have = room[left].pop()
            if not room[left]:
                del room[left]
                spaces.pop(at)
            each = min(left // length, n)
            used = min(have, n // each)
            if used < have:
                keep(held, have - used, left)
            keep(held | {length: each}, used, left - each * length)
            n -= used * each
    return done + [x for found in room.values() for x in found]


def plan(counts: dict[int, int], capacity: int, solves: int = 3, seed: int = 5) -> tuple[list[tuple[dict[int, int], int]], int]:
    """(configuration, how many sequences of it) that hold all pieces, and how many sequences stem from the program.

    The program's solution is rounded so that the running total of its amounts is, and taken as far as pieces are left;
    of configurations that still have room for a piece none are taken. What is left makes a smaller program, solved again;
    the rest of the last one is packed by best fit. Should best fit need fewer sequences for all pieces alone (lengths
    spread evenly up to the capacity, few of each), its packing is returned.
    """
    random, left, out = np.random.default_rng(seed), {k: n for k, n in counts.items() if n}, []
    for _ in range(solves):
        if not left:
            break
        found = configurations(left, capacity, random)
        times = np.diff(np.floor(np.cumsum([x for _, x in found]) + random.random()), prepend=0).astype(int).tolist()
        smallest, taken = min(left), 0
        for (held, _), n in zip(found, times, strict=True):
            n = min(n, *(left.get(k, 0) // m for k, m in held.items()))
            if n > 0 and capacity - sum(k * m for k, m in held.items()) < smallest:
                out.append((held, n))
                taken += n
                for k, m in held.items():
                    left[k] -= n * m
        left = {k: n for k, n in left.items() if n}
        if not taken:
            break
    program, alone = sum(n for _, n in out), best_fit({k: n for k, n in counts.items() if n}, capacity)
    out += best_fit(left, capacity)
    if sum(n for _, n in alone) < sum(n for _, n in out):
        return alone, 0
    return out, program


class Places:
    """For each length, which ranks go to which sequences and offsets."""

    def __init__(self, sequences: list[tuple[dict[int, int], int]]):
        by_length: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        first = 0
        for held, n in sequences:
            offset = 0
            for length, m in sorted(held.items(), reverse=True):
                begin = taken.get(length, 0)
                by_length.setdefault(length, []).append((begin, first, m, offset))
                taken[length] = begin + n * m
                offset += m * length
            first += n
        self.count = first
        self.by_length = {k: np.array(v, dtype=np.int64) for k, v in by_length.items()}

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(ranks), dtype=np.int64), np.empty(len(ranks), dtype=np.int64)
        order = np.argsort(lengths, kind="stable")
        ends = np.flatnonzero(np.append(np.diff(lengths[order]) != 0, True)) + 1
        for rows in np.split(order, ends[:-1]) if len(order) else []:
            table = self.by_length[int(lengths[rows[0]])]
            begin, first, m, at = table[np.searchsorted(table[:, 0], ranks[rows], side="right") - 1].T
            nth = ranks[rows] - begin
            sequence[rows] = first + nth // m
            offset[rows] = at + nth % m * lengths[rows]
        return sequence, offset


def pack(pieces: DataFrame, capacity: int = 4096, key_cols: tuple[str, ...] = ("id", "piece")) -> DataFrame:
    """pieces with sequence_id and offset. Needs the long column `length`, from 1 to capacity.

    Ranks within a length are counted within hashed portions of it, so a length that very many pieces share is counted
    by many tasks; the portions' sizes (length, portion, count) are summed up into where each portion begins.
    """
    held = Stored(pieces)
    total = held.df.count()
    portions = int(min(4096, max(64, total // 100_000)))
    split = held.df.withColumn("_portion", F.pmod(F.xxhash64(*key_cols), F.lit(portions)).cast("int"))
    sizes = Stored(split.groupBy("length", "_portion").agg(F.count("*").alias("_n")))
    counts = {int(r["length"]): int(r["n"]) for r in sizes.df.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("_portion").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.df.select(F.col("length").alias("_length"), F.col("_portion").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_begin"))
    nth = F.row_number().over(Window.partitionBy("length", "_portion").orderBy(*key_cols)) - 1
    ranked = split.withColumn("_nth", nth.cast("long")).join(begins, (F.col("length") == F.col("_length")) & (F.col("_portion") == F.col("_p")))
    ranked = ranked.select(*pieces.columns, (F.col("_begin") + F.col("_nth")).alias("_rank"))
    places = pieces.sparkSession.sparkContext.broadcast(Places(plan(counts, capacity)[0]))

    columns = pieces.columns

    def placed(batches):
        for batch in batches:
            found = places.value.of(batch.column("length").to_numpy(zero_copy_only=False), batch.column("_rank").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *map(pa.array, found)], [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(placed, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """The pieces of docs and their places."""
    return pack(token_pieces(docs, tokenizer_file, capacity, end_id), capacity).withColumnRenamed("id", "doc_id")
