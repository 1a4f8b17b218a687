"""Token counts by a compiled finite-state transducer.

A byte-fallback BPE vocabulary is turned into a deterministic transducer whose transitions carry the number of tokens
that they add. A state describes a prefix of a text by those earlier positions from which a piece may still reach over
its end: for each, the piece prefix read since, the token count there relative to the count here, and the class of the
token that ends there. Two facts make that exact. If a boundary is in the final segmentation, both sides of it are
segmented on their own; and a sequence of pieces is the segmentation of their text when each adjacent pair is. Which
pairs are depends on a token only through the merges that its right edge allows, so tokens fall into classes.

States are made when a text first needs them, like those of a lazy regular-expression automaton, and thrown away
between batches once there are too many of them. A batch is one symbol stream cut into chunks of equal length. A chunk's
map says for each state that may enter it in which state it ends and what its symbols add. As there is no end to the
states, a map is made for the root and for whatever its predecessor's map leads to, until that holds nothing new; equal
chunks share their runs, and a run stops where it meets the one from the root. All runs of a round advance together. The
maps, then closed, are composed by a parallel prefix scan of log2(chunks) steps, which gives the state that enters each
chunk. Where nothing is remembered over a chunk that takes two rounds; in runs of one character, as many as the phases
that a piece may have.

Defined results: null and empty texts have 0 bytes and 0 tokens; a character that the vocabulary lacks counts one token
per UTF-8 byte; one row is returned per input row, repeated ones too; other columns are not read.
"""

from __future__ import annotations

import bisect
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import in_parts

RESET, N_SPECIAL = 0, 5  # symbol 0 ends a text; 1 to 4: an unknown character of so many bytes
SPACE = "▁"
_NONE = -1
_STATE = struct.Struct("<iii")
_SHIFT = 32  # a chunk and a state in one number
_LOW = (1 << _SHIFT) - 1


def composed(maps: np.ndarray) -> np.ndarray:
    """Row i: the composition of the maps 0 to i, the first applied first (Hillis and Steele's scan)."""
    done = 1
    while done < len(maps):
        maps = np.concatenate([maps[:done], np.take_along_axis(maps[done:], maps[:-done], axis=1)])
        done *= 2
    return maps


class Merges:
    """The pieces of a BPE model, the rank at which two adjacent pieces merge, and the edges of each piece."""

    def __init__(self, ranks: dict[str, float]):
        self.ranks = ranks
        self.allowed: dict[str, list[float]] = {}
        for whole, rank in ranks.items():
            for k in range(1, len(whole)):
                if whole[:k] in ranks and whole[k:] in ranks:
                    self.allowed.setdefault(whole[:k], []).append(rank)
        for found in self.allowed.values():
            found.sort()
        self.classes: list[list[tuple[str, float]]] = []
        self._class_of: dict[str, int] = {}
        self._ids: dict[tuple, int] = {}
        self._left: dict[str, list[tuple[str, float]]] = {}
        self._halves: dict[str, tuple[str, str]] = {}

    def segment(self, text: str, stop: int = 1) -> list[str]:
        """Plain BPE, down to stop pieces at least."""
        parts = list(text)
        while len(parts) > stop:
            best = min(((self.ranks.get(parts[i] + parts[i + 1], np.inf), i) for i in range(len(parts) - 1)), default=(np.inf, 0))
            if best[0] == np.inf:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def halves(self, piece: str) -> tuple[str, str]:
        if piece not in self._halves:
            self._halves[piece] = tuple(self.segment(piece, 2))
        return self._halves[piece]

    def class_of(self, piece: str) -> int:
        """Tokens of one class may stand before the same tokens."""
        found = self._class_of.get(piece)
        if found is None:
            edge, key, u, limit = [], [], piece, np.inf
            while True:
                if n := bisect.bisect_left(self.allowed.get(u, ()), limit):
                    edge.append((u, limit))
                    key.append((u, n))
                if len(u) == 1:
                    break
                limit, u = self.ranks[u], self.halves(u)[1]
            found = self._ids.setdefault(tuple(key), len(self.classes))
            if found == len(self.classes):
                self.classes.append(edge)
            self._class_of[piece] = found
        return found

    def left_edge(self, piece: str) -> list[tuple[str, float]]:
        found = self._left.get(piece)
        if found is None:
            found, v, limit = [], piece, np.inf
            while True:
                found.append((v, limit))
                if len(v) == 1:
                    break
                limit, v = self.ranks[v], self.halves(v)[0]
            self._left[piece] = found
        return found

    def may_follow(self, last: int, piece: str) -> bool:
        """Whether no merge crosses the boundary between a token of class last and this one."""
        if last == _NONE:
            return True
        get, left = self.ranks.get, self.left_edge(piece)
        for u, of_u in self.classes[last]:
            for v, of_v in left:
                rank = get(u + v)
                if rank is not None and rank < of_u and rank <= of_v:  # of equal merges the left one is done first
                    return False
        return True


class Transducer:
    def __init__(self, ranks: dict[str, float], most_states: int = 800_000):
        self.merges, self.most_states = Merges(ranks), most_states
        prefixes = sorted({piece[:k] for piece in ranks for k in range(len(piece) + 1)})
        self.prefixes, self.prefix_id = prefixes, {p: i for i, p in enumerate(prefixes)}
        self.longer: dict[str, list[str]] = {}
        for piece in ranks:
            for k in range(1, len(piece)):
                self.longer.setdefault(piece[:k], []).append(piece)
        chars = sorted(p for p in ranks if len(p) == 1)
        self.symbols = [""] * N_SPECIAL + chars
        code = np.arange(0x110000)
        self.symbol_of = (1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)).astype(np.uint16)
        self.symbol_of[[ord(c) for c in chars]] = np.arange(N_SPECIAL, N_SPECIAL + len(chars))
        self.symbol_of[0x20] = self.symbol_of[ord(SPACE)]
        self._begin()

    def _begin(self) -> None:
        self.states: list[bytes] = []
        self.ids: dict[bytes, int] = {}
        self.bits, self.used = 20, 0
        self._table(self.bits)
        self._reach: dict[tuple[int, int], bool] = {}
        self.root = self._state(_STATE.pack(self.prefix_id[""], 0, _NONE))

    def _table(self, bits: int) -> None:
        """Rows of (state and symbol, next state and tokens added), found by open addressing."""
        self.table = np.full((1 << bits, 2), -1, dtype=np.int64)

    def _state(self, key: bytes) -> int:
        found = self.ids.setdefault(key, len(self.states))
        if found == len(self.states):
            self.states.append(key)
        return found

    def _reaches(self, last: int, prefix: int) -> bool:
        """Whether any longer piece with this prefix may stand after such a token."""
        key = (last, prefix)
        found = self._reach.get(key)
        if found is None:
            longer = self.longer.get(self.prefixes[prefix], ())
            # with many pieces one of them nearly always may; to keep a prefix that none may end costs a state, no more
            found = self._reach[key] = len(longer) > 8 or any(self.merges.may_follow(last, t) for t in longer)
        return found

    def compile(self, state: int, symbol: int) -> tuple[int, int]:
        if symbol == RESET:
            return self.root, 0
        if symbol < N_SPECIAL:
            return self.root, symbol
        x, ranks, out = self.symbols[symbol], self.merges.ranks, []
        open_ones = [(self.prefixes[p] + x, dn, last) for p, dn, last in _STATE.iter_unpack(self.states[state])]
        for piece, dn, last in open_ones:
            if piece in ranks and self.merges.may_follow(last, piece):
                n, ends = dn + 1, self.merges.class_of(piece)
                break
        for piece, dn, last in open_ones:
            p = self.prefix_id.get(piece)
            if p is not None and self._reaches(last, p):
                out.append(_STATE.pack(p, dn - n, last))
        out.append(_STATE.pack(self.prefix_id[""], 0, ends))
        return self._state(b"".join(out)), n

    def _rows(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key stands, or the free place that it would take, and what is there."""
        mask = (1 << self.bits) - 1
        slot = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).view(np.int64)
        rows = self.table.take(slot, axis=0)
        again = np.flatnonzero((rows[:, 0] != keys) & (rows[:, 0] >= 0))
        while len(again):
            slot[again] = (slot[again] + 1) & mask
            rows[again] = there = self.table[slot[again]]
            again = again[(there[:, 0] != keys[again]) & (there[:, 0] >= 0)]
        return slot, rows

    def _put(self, new: np.ndarray) -> None:
        if 2 * (self.used + len(new)) > len(self.table):
            old = self.table[self.table[:, 0] >= 0]
            self.bits = max(self.bits + 1, int(2 * (self.used + len(new))).bit_length())
            self._table(self.bits)
            self.used = 0
            self._put(old)
        self.used += len(new)
        while len(new):
            slot, _ = self._rows(np.ascontiguousarray(new[:, 0]))
            self.table[slot] = new  # of several that want one place, the last gets it
            new = new[self.table[slot, 0] != new[:, 0]]

    def step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = states * np.int64(len(self.symbols)) + symbols
        _, rows = self._rows(keys)
        if rows[:, 0].min() < 0:
            missing = np.flatnonzero(rows[:, 0] < 0)
            new = np.unique(keys[missing])
            made = [self.compile(*divmod(int(k), len(self.symbols))) for k in new]
            self._put(np.array([[k, to << 16 | n + 0x8000] for k, (to, n) in zip(new, made, strict=True)], dtype=np.int64))
            rows[missing] = self._rows(keys[missing])[1]
        value = rows[:, 1]
        return value >> 16, (value & 0xFFFF) - 0x8000

    def _from(self, entries: np.ndarray, stream: np.ndarray, states: np.ndarray, adds: np.ndarray, record: bool) -> np.ndarray:
        """Runs the columns of stream from their entries until each meets the states already known for it (record: there
        are none yet); fills in adds and, to record, states; gives the last states."""
        last = states[-1].copy()
        now, left = entries, np.arange(len(entries))
        for t in range(len(stream)):
            now, adds[t, left] = self.step(now, stream[t, left].astype(np.int64))
            if record:
                states[t] = now
                continue
            apart = states[t, left] != now
            now, left = now[apart], left[apart]
            if not len(left):
                return last
        last[left] = now
        return last

    def run(self, symbols: np.ndarray, entry: int, chunk: int = 256) -> tuple[np.ndarray, int]:
        """The tokens that each symbol adds (and may take back), and the last state."""
        n = len(symbols)
        if not n:
            return np.zeros(0, dtype=np.int32), entry
        lanes = -(-n // chunk)
        stream = np.full(lanes * chunk, RESET, dtype=np.uint16)
        stream[:n] = symbols
        _, first, content = np.unique(stream.view(np.dtype((np.void, 2 * chunk))), return_index=True, return_inverse=True)
        body = np.ascontiguousarray(stream.reshape(lanes, chunk)[first].T)  # a column per distinct chunk
        states = np.empty(body.shape, dtype=np.int64)
        adds = [np.empty(body.shape, dtype=np.int32)]
        ends = self._from(np.full(len(first), self.root), body, states, adds[0], True)
        run_of = {c << _SHIFT | self.root: c for c in range(len(first))}

        # the states that may enter each chunk: closed under what its predecessor's map gives
        lane, state = np.append(np.arange(lanes), 0), np.append(np.full(lanes, self.root), entry)
        asked = np.unique(lane << _SHIFT | state)
        pairs, runs = [], []
        while len(asked):
            lane, state = asked >> _SHIFT, asked & _LOW
            keys = content[lane] << _SHIFT | state
            new = np.array(sorted({k for k in keys.tolist() if k not in run_of}), dtype=np.int64)
            if len(new):
                c = new >> _SHIFT
                more = adds[0][:, c]
                run_of.update(zip(new.tolist(), range(len(ends), len(ends) + len(new))))
                ends = np.append(ends, self._from(new & _LOW, body[:, c], states[:, c], more, False))
                adds.append(more)
            pairs.append(asked)
            runs.append(np.array([run_of[k] for k in keys.tolist()], dtype=np.int64))
            out = np.unique((lane + 1 << _SHIFT | ends[runs[-1]])[lane + 1 < lanes])
            asked = out[~np.isin(out, np.concatenate(pairs))]
        pairs, runs = np.concatenate(pairs), np.concatenate(runs)
        order = np.argsort(pairs)
        pairs, runs = pairs[order], runs[order]
        lane = pairs >> _SHIFT
        start = np.searchsorted(lane, np.arange(lanes))
        here = np.zeros(lanes, dtype=np.int64)
        here[0] = np.searchsorted(pairs, entry)
        if lanes > 1:
            # row i: the map from the states that may enter chunk i to those that may enter chunk i + 1
            inner = np.flatnonzero(lane + 1 < lanes)
            maps = np.zeros((lanes - 1, np.bincount(lane).max()), dtype=np.int64)
            maps[lane[inner], inner - start[lane[inner]]] = np.searchsorted(pairs, lane[inner] + 1 << _SHIFT | ends[runs[inner]]) - start[lane[inner] + 1]
            here[1:] = start[1:] + composed(maps)[:, here[0]]
        taken = runs[here]
        state = int(pairs[here[-1]] & _LOW)
        for x in symbols[(lanes - 1) * chunk :]:
            state = int(self.step(np.array([state]), np.array([x], dtype=np.int64))[0][0])
        return np.concatenate(adds, axis=1)[:, taken].T.reshape(-1)[:n], state

    def counts(self, texts: list[str], block: int = 1 << 20) -> list[int]:
        if len(self.states) > self.most_states:
            self._begin()
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        if not len(lengths):
            return []
        if lengths.max() > block:
            return [self._long(t, block) if len(t) > block else self.counts([t])[0] for t in texts]
        starts = np.concatenate([[0], np.cumsum(lengths + 2)])
        stream = np.empty(starts[-1], dtype=np.uint16)
        body = np.ones(len(stream), dtype=bool)
        body[starts[:-1]] = body[starts[:-1] + 1] = False
        stream[body] = self.symbol_of[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        stream[starts[:-1]] = RESET
        stream[starts[:-1] + 1] = np.where(lengths > 0, self.symbol_of[ord(SPACE)], RESET)
        adds, _ = self.run(stream, self.root)
        return np.add.reduceat(adds, starts[:-1]).tolist()

    def _long(self, text: str, block: int) -> int:
        total, state = 0, self.root
        for i in range(0, len(text), block):
            part = (SPACE if i == 0 else "") + text[i : i + block]
            adds, state = self.run(self.symbol_of[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")], state)
            total += int(adds.sum())
        return total


@lru_cache(maxsize=2)
def piece_transducer(model_file: str) -> Transducer:
    """The transducer of a sentencepiece BPE model with byte fallback and the identity normaliser."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(model_file, "rb") as f:
        model.ParseFromString(f.read())
    if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or model.normalizer_spec.name != "identity" or model.normalizer_spec.remove_extra_whitespaces or not model.normalizer_spec.add_dummy_prefix:
        raise ValueError("only BPE models with byte fallback, a dummy prefix and no normalisation are compiled")
    return Transducer({p.piece: -p.score for p in model.pieces if p.type == 1})


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row; model_file must be readable on every executor."""

    def counted(batches):
        machine = piece_transducer(model_file)
        for batch in batches:
            for part in in_parts(batch, text_col):
                texts = pc.fill_null(part.column(text_col), "")
                n = np.array(machine.counts(texts.to_pylist()), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([part.column(id_col), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(n), pa.array(n > limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(counted, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
