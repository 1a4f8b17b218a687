"""Cropped and edited copies of images by local descriptors.

Corners are found at several scales; each gets an orientation from the intensity centroid around it and a 64-bit
string of binary tests turned by that orientation. Two Hamming tables hold the strings by their halves: strings that
differ in one bit stand together in one of them at least, and in an image of many corners one that differs in three
still has others that do. An entry of a table is a half with the orientation (copies that are turned aren't linked) and the
offset to the nearest other corner of the scale, so that unrelated images, however many there are, hardly share one. An entry that
two or more images share makes them candidates, and each shared entry is a vote. Pairs of enough votes (VOTE_SHARE of the
corners that a link needs) are compared: corners whose strings are at a Hamming distance of three or less vote for a scale
and a shift, and the images are linked if enough corners of the smaller one agree on one. Classes are the components of the
links; equal images are one image until the end.

Entries are kept in blocks of packed arrays, dealt by their bits. The images of an entry of FEW or less all meet; of an entry
of more, all meet its HUBS smallest images first, which are the ones that what they share is most likely to link. Such an
entry stays open as long as its images lie in several components and could still be linked by what is open: then they meet
the next eight times as many, and so on until nothing is open. So every image meets every other of its
entries, but for those already in one component with it and for images of which so few corners are left in open
entries that no link can come of it.

The tables here have no images, so the media column is made from `pages`: render_pages() draws the visible text, one
paragraph below the other, each word a cell of its own grey. A page that repeats another's paragraphs, or a part of them, is an image
that shows the same region elsewhere.

Consensus is on scale and shift: copies that are turned as a whole match by their strings but are not linked.

Defined results: null, empty and malformed images are alone; images of fewer than three corners have their equals
only; one row per input row; rows with a null id are alone; ids may repeat (a class's id is the least of its rows); an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stored, components, heavy_from, in_parts, mix, spread_join, text_bytes, word_hashes, words

WORDS, CELL = 24, 2  # of the rendered pages: words a row, pixels a word's cell is wide and high
WIDTH = WORDS * CELL
SCALES = (1, 2)
RADIUS = 4
#: Images with fewer corners have equal images only.
FEWEST = 3
#: About so many votes of a pair of images are counted at a time.
VOTES = 1_000_000
#: Of an entry of more than FEW images, all meet the smallest HUBS first.
FEW, HUBS = 8, 4
#: Entries of a block, about.
BLOCK = 1_000_000
#: A pair is compared if it has so many votes in a round, as a share of the corners that a link needs. Copies have two
#: for each corner (one in each table) whose nearest corner stands as it did, over a few rounds.
VOTE_SHARE = 0.3
#: Pixels that are searched for corners at a time, about.
PIXELS = 150_000
#: How far the nearest corner may be to be told from none.
NEAR = 8
#: Rows that are broadcast or sent to the driver at most.
MOST_HELD = 500_000
_random = np.random.default_rng(11)
#: The binary tests: 64 pairs of offsets within the radius.
TESTS = _random.uniform(-RADIUS, RADIUS, (64, 2, 2))
_ANGLES = 16
_TURNED = np.stack([np.rint(TESTS @ np.array([[np.cos(t), np.sin(t)], [-np.sin(t), np.cos(t)]])).astype(np.int64) for t in 2 * np.pi * np.arange(_ANGLES) / _ANGLES])
_yy, _xx = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1]
_MOMENTS = np.stack([_yy.ravel(), _xx.ravel()], axis=1).astype(np.float32)
_OFFSETS = sorted((i * i + j * j, i, j) for i in range(-NEAR, NEAR + 1) for j in range(-NEAR, NEAR + 1) if 0 < i * i + j * j <= NEAR * NEAR)
_RINGS = [(_OFFSETS.index(ring[0]), np.array(ring)[:, 1:]) for ring in (list(x) for _, x in itertools.groupby(_OFFSETS, key=lambda x: x[0]))]
_POPCOUNT = np.array([bin(i).count("1") for i in range(1 << 16)], dtype=np.uint8)

_HIDDEN = re.compile(r"<(script|style|nav|title)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
_BREAK = re.compile(r"</?(?:p|h[1-6]|div|li|br|tr|article|table|section)\b[^>]*>", re.I)
_TAG = re.compile(r"<[^>]*>")


def draw(pages: list[str]) -> list[np.ndarray]:
    """The visible text of each page as a grey image of WIDTH columns: a word is a cell of its own grey, paragraphs begin rows."""
    paragraphs, of_page = [], []
    for i, html in enumerate(pages):
        text = unescape(_TAG.sub("", _BREAK.sub("\n", _HIDDEN.sub("\n", html))))
        held = [x for x in text.split("\n") if x and not x.isspace()]
        paragraphs += held
        of_page += [i] * len(held)
    raw, offsets = text_bytes(pa.array(paragraphs, pa.string()))
    starts, ends = words(raw)
    paragraph = np.searchsorted(offsets, starts, side="right") - 1
    count = np.bincount(paragraph, minlength=len(paragraphs))
    rows = -(-count // WORDS)
    first = np.cumsum(rows) - rows
    place = np.arange(len(starts)) - (np.cumsum(count) - count)[paragraph]
    cells = np.zeros((int(rows.sum()), WORDS), dtype=np.uint8)
    cells[first[paragraph] + place // WORDS, place % WORDS] = (word_hashes(raw, starts, ends) >> np.uint64(56)) | np.uint64(1)
    image = cells.repeat(CELL, axis=0).repeat(CELL, axis=1)
    ends = np.cumsum(np.bincount(np.array(of_page, dtype=np.int64), weights=rows, minlength=len(pages)).astype(np.int64)) * CELL
    return [image[i:j] for i, j in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)]


def render_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(id, width, pixels) of each page; pixels are rows of grey values."""

    def drawn(batches):
        for batch in batches:
            for part in in_parts(batch, html_col):
                images = draw([x or "" for x in part.column(html_col).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array([WIDTH] * len(images), pa.int32()), pa.array([x.tobytes() for x in images], pa.binary())], ["id", "width", "pixels"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, html_col).mapInArrow(drawn, f"id {kind}, width int, pixels binary")


def _box(x: np.ndarray) -> np.ndarray:
    """Sums over 3 × 3."""
    p = np.pad(x, 1)
    rows = p[:-2] + p[1:-1] + p[2:]
    return rows[:, :-2] + rows[:, 1:-1] + rows[:, 2:]


def _corners(images: list[np.ndarray], scale: int) -> tuple[np.ndarray, ...]:
    """(image, y, x, string, turn, near) of the corners of images of one width."""
    m, w = RADIUS + 1, images[0].shape[1] // scale
    high = np.array([len(x) // scale for x in images])
    use = np.flatnonzero(high >= 2 * RADIUS + 3) if w >= 2 * RADIUS + 3 else np.zeros(0, np.int64)
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 2
    if not len(use):
        return none
    # one below the other, each with a row of its own above and below, so that borders are as if it were alone
    high = high[use]
    begin = np.cumsum(high + 2) - high - 1
    small = np.zeros((int((high + 2).sum()), w), dtype=np.float32)
    for k, i, h in zip(use, begin, high, strict=True):
        part = images[k][: h * scale, : w * scale]
        small[i : i + h] = part if scale == 1 else part.reshape(h, scale, w, scale).mean(axis=(1, 3))
    gy, gx = np.zeros_like(small), np.zeros_like(small)
    gy[1:-1] = small[2:] - small[:-2]
    gx[:, 1:-1] = small[:, 2:] - small[:, :-2]
    a, b, c = _box(gx * gx), _box(gx * gy), _box(gy * gy)
    strength = a * c - b * b - np.float32(0.05) * (a + c) ** 2
    inner = strength[m:-m, m:-m]
    peak = inner > 1e4
    for i, j in ((0, 1), (0, -1), (1, 0), (-1, 0), (1, 1), (1, -1), (-1, 1), (-1, -1)):
        peak &= inner > strength[m + i : len(small) - m + i, m + j : w - m + j]
    y, x = np.nonzero(peak)
    y, x = y + m, x + m
    k = np.searchsorted(begin, y, side="right") - 1
    inside = (y - begin[k] >= m) & (y - begin[k] < high[k] - m) & (k >= 0)
    y, x, k = y[inside], x[inside], k[inside]
    if not len(y):
        return none
    at = y * w + x
    moments = (small.ravel()[at[:, None] + (_yy * w + _xx).ravel()] @ _MOMENTS).astype(np.float64)
    turn = np.rint(np.arctan2(moments[:, 0], moments[:, 1]) / (2 * np.pi) * _ANGLES).astype(np.int64) % _ANGLES
    smooth = _box(small)
    smooth[begin - 1], smooth[begin + high] = smooth[begin], smooth[begin + high - 1]
    smooth = np.pad(smooth, ((0, 0), (1, 1)), mode="edge").ravel()
    tests, middle = _TURNED[..., 0] * (w + 2) + _TURNED[..., 1], (y * (w + 2) + x + 1)[:, None]
    bits = smooth[middle + tests[..., 0][turn]] < smooth[middle + tests[..., 1][turn]]
    # corners are RADIUS + 1 from every border at least, so what is within NEAR is of the same image
    held = np.zeros(small.size, dtype=bool)
    held[at] = True
    near, left = np.full(len(at), len(_OFFSETS)), np.arange(len(at))
    for first, ring in _RINGS:
        hit = held.take(at[left, None] + (ring[:, 0] * w + ring[:, 1]), mode="wrap")
        some = hit.any(axis=1)
        near[left[some]] = first + hit[some].argmax(axis=1)
        left = left[~some]
        if not len(left):
            break
    return use[k], y - begin[k], x, np.packbits(bits, axis=1).view("<u8").ravel(), turn, near


def describe_all(images: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(corners × (y, x, scale), 64-bit strings, corners × (orientation, number of the offset to the nearest corner)) of grey images."""
    out: list = [None] * len(images)
    of_width: dict[int, list[int]] = {}
    for i, x in enumerate(images):
        of_width.setdefault(x.shape[1], []).append(i)
    for ids in of_width.values():
        size = np.cumsum([images[i].size + 2 * images[i].shape[1] for i in ids])
        for part in np.split(np.array(ids), np.flatnonzero(np.diff(size // PIXELS)) + 1):
            found = [_corners([images[i] for i in part], scale) for scale in SCALES]
            k = np.concatenate([f[0] for f in found])
            order = np.argsort(k, kind="stable")
            corners = np.concatenate([np.stack([f[1] * s, f[2] * s, np.full(len(f[1]), s)], axis=1) for f, s in zip(found, SCALES, strict=True)])[order]
            strings = np.concatenate([f[3] for f in found])[order]
            around = np.concatenate([np.stack(f[4:], axis=1) for f in found])[order]
            cuts = np.searchsorted(k[order], np.arange(1, len(part)))
            for i, *one in zip(part, *(np.split(x, cuts) for x in (corners, strings, around)), strict=True):
                out[i] = tuple(one)
    return out


def describe(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(corners × (y, x, scale), 64-bit strings) of a grey image."""
    return describe_all([image])[0][:2]


def _shifts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The scale and shift that take each of the corners a to its b, coarsely, as one number."""
    sa, sb = a[:, 2], b[:, 2]
    scale = np.rint(2 * np.log2(sb / sa)).astype(np.int64) + 8
    dy = np.rint((b[:, 0] - a[:, 0] * sb / sa) / 4).astype(np.int64) + (1 << 26)
    dx = np.rint((b[:, 1] - a[:, 1] * sb / sa) / 4).astype(np.int64) + (1 << 26)
    return scale << 54 | dy << 27 | dx


def agreeing(corners_a: np.ndarray, strings_a: np.ndarray, corners_b: np.ndarray, strings_b: np.ndarray, near: int = 3) -> int:
    """How many corners of a match corners of b under the most popular scale and shift."""
    # strings that an image repeats are compared once
    own, of_a = np.unique(strings_a, return_inverse=True)
    other, of_b = np.unique(strings_b, return_inverse=True)
    met = []
    for shift in (0, 16, 32, 48):
        ka, kb = own >> np.uint64(shift) & np.uint64(0xFFFF), other >> np.uint64(shift) & np.uint64(0xFFFF)
        order = np.argsort(kb, kind="stable")
        low, n = np.searchsorted(kb[order], ka), np.searchsorted(kb[order], ka, side="right")
        n -= low
        i = np.repeat(np.arange(len(ka)), n)
        j = order[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        differ = own[i] ^ other[j]
        distance = sum(_POPCOUNT[(differ >> np.uint64(s) & np.uint64(0xFFFF)).astype(np.int64)].astype(np.int64) for s in (0, 16, 32, 48))
        met.append((i * len(other) + j)[distance <= near])
    met = np.unique(np.concatenate(met))
    if not len(met):
        return 0
    u, v = met // len(other), met % len(other)
    first, last = np.searchsorted(u, np.arange(len(own))), np.searchsorted(u, np.arange(len(own)), side="right")
    places = np.argsort(of_b, kind="stable")
    times = np.bincount(of_b, minlength=len(other))
    begin = np.cumsum(times) - times
    work = np.bincount(u, weights=times[v], minlength=len(own)).astype(np.int64)[of_a]
    bins, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    # a block of corners of a at a time: each corner is in one block, so the counts of the blocks add up
    block = np.cumsum(work) // VOTES
    for at in np.split(np.arange(len(of_a)), np.flatnonzero(np.diff(block)) + 1):
        some = last[of_a[at]] - first[of_a[at]]
        i = np.repeat(at, some)
        k = v[np.repeat(first[of_a[at]], some) + np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)]
        n = times[k]
        j = places[np.repeat(begin[k], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        i = np.repeat(i, n)
        where, place = np.unique(_shifts(corners_a[i], corners_b[j]), return_inverse=True)
        votes = np.unique(place * len(of_a) + i) // len(of_a)
        bins, place = np.unique(np.concatenate([bins, where]), return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate([counts, np.bincount(votes, minlength=len(where))]), minlength=len(bins)).astype(np.int64)
    return int(counts.max())


def agreeing_in(pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], near: int = 3) -> np.ndarray:
    """agreeing() of each of many pairs (corners_a, strings_a, corners_b, strings_b) at once."""
    if not pairs:
        return np.zeros(0, np.int64)
    na, nb = (np.array([len(x[k]) for x in pairs]) for k in (1, 3))
    ca, sa, cb, sb = (np.concatenate([x[k] for x in pairs]) for k in range(4))
    of_a, of_b = np.repeat(np.arange(len(pairs)), na), np.repeat(np.arange(len(pairs)), nb)
    met, work = [], np.zeros(len(pairs), np.int64)
    for shift in (0, 16, 32, 48):
        ka, kb = (of << 16 | (s >> np.uint64(shift) & np.uint64(0xFFFF)).astype(np.int64) for of, s in ((of_a, sa), (of_b, sb)))
        order = np.argsort(kb, kind="stable")
        kb = kb[order]
        low = np.searchsorted(kb, ka)
        n = np.searchsorted(kb, ka, side="right") - low
        work = np.maximum(work, np.bincount(of_a, weights=n, minlength=len(pairs)).astype(np.int64))
        met.append((order, low, n))
    alone = work > VOTES // 20  # their matches would not fit beside the others'
    i, j = [], []
    for order, low, n in met:
        n = np.where(alone[of_a], 0, n)
        u = np.repeat(np.arange(len(n)), n)
        v = order[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        differ = sa[u] ^ sb[v]
        close = sum(_POPCOUNT[(differ >> np.uint64(s) & np.uint64(0xFFFF)).astype(np.int64)] for s in (0, 16, 32, 48)) <= near
        i.append(u[close]), j.append(v[close])
    i, j = np.concatenate(i), np.concatenate(j)
    out = np.zeros(len(pairs), np.int64)
    if len(i):
        where, place = np.unique(_shifts(ca[i], cb[j]), return_inverse=True)
        votes = np.unique(i * len(where) + place)
        bins, n = np.unique(of_a[votes // len(where)] * len(where) + votes % len(where), return_counts=True)
        np.maximum.at(out, bins // len(where), n)
    for k in np.flatnonzero(alone):
        out[k] = agreeing(*pairs[k], near)
    return out


def packed_corners(corners: np.ndarray, around: np.ndarray) -> bytes:
    """Corners as find_copies() keeps them."""
    return zlib.compress(np.stack([np.diff(corners[:, 0], prepend=0), corners[:, 1], corners[:, 2], around[:, 0] << 8 | around[:, 1]]).astype("<i4").tobytes(), 1)


def unpacked_corners(held: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(y, x, scale) and (orientation and nearest corner in one number) of the corners of packed_corners()."""
    dy, x, scale, around = np.frombuffer(zlib.decompress(held), dtype="<i4").reshape(4, -1).astype(np.int64)
    return np.stack([np.cumsum(dy), x, scale], axis=1), around


def needed(m: int, n: np.ndarray, least: int, share: float) -> np.ndarray:
    """How many corners must agree in images of m and n corners: of few corners three quarters, FEWEST at least."""
    few = np.minimum(m, n)
    return np.maximum(np.clip(0.75 * few, FEWEST, max(least, FEWEST)), share * few)


def asked(n: np.ndarray, least: int, share: float) -> np.ndarray:
    """How many votes images of n corners ask for."""
    return np.ceil(VOTE_SHARE * needed(1 << 40, n, least, share)).astype(np.int64)


def _squeezed(x: np.ndarray) -> bytes:
    """The bytes of numbers, place by place."""
    return zlib.compress(x.view(np.uint8).reshape(len(x), -1).T.tobytes(), 1)


def _spread_out(x: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(x), dtype=np.uint8).reshape(size, -1).T).view(kind).ravel()


def blocks(images: DataFrame, n_blocks: int) -> DataFrame:
    """(block, rows, sizes, entries, places): the distinct entries of images (row, corners, strings), packed.

    An entry is a half of a string with the corner's orientation and the offset to its nearest corner. places tells which
    of rows has the entry; sizes are the numbers of corners.
    """

    def packed(batches):
        for batch in batches:
            for at in range(0, len(batch), 10_000):  # places are of 16 bits
                part = batch.slice(at, 10_000)
                rows, n = part.column("row").to_numpy(), part.column("n").to_numpy().astype(np.int64)
                strings = np.frombuffer(b"".join(part.column("strings").to_pylist()), dtype="<u8")
                around = np.concatenate([unpacked_corners(x)[1] for x in part.column("corners").to_pylist()]).astype(np.uint64)
                keys = mix(np.concatenate([(strings >> np.uint64(32)) << np.uint64(16) | around, (strings & np.uint64(0xFFFFFFFF)) << np.uint64(16) | around | np.uint64(1 << 48)]))
                keys = (keys & np.uint64(0xFFFFFFFF)) % np.uint64(n_blocks) << np.uint64(32) | keys >> np.uint64(32)
                order = np.argsort(keys, kind="stable")
                keys, place = keys[order], np.tile(np.repeat(np.arange(len(part)), n), 2)[order]
                new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (place[1:] != place[:-1])])
                keys, place = keys[new], place[new]
                block = (keys >> np.uint64(32)).astype(np.int64)
                first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
                out = []
                for i, j in itertools.pairwise([*first, len(block)]):
                    own, of = np.unique(place[i:j], return_inverse=True)
                    entry = (keys[i:j] & np.uint64(0xFFFFFFFF)).astype(np.int64)
                    out.append((block[i], _squeezed(np.diff(rows[own], prepend=0)), _squeezed(n[own]), _squeezed(np.diff(entry, prepend=0).astype("<u4")), _squeezed(of.astype("<u2"))))
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.int64(), *[pa.binary()] * 4), strict=True)], ["block", "rows", "sizes", "entries", "places"])

    return images.select("row", "n", "corners", "strings").mapInArrow(packed, "block long, rows binary, sizes binary, entries binary, places binary")


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each place in sorted keys: its place among the equal ones, and how many these are."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(key)))
    return np.arange(len(key)) - np.repeat(first, n), np.repeat(n, n)


def _votes(row: np.ndarray, asks: np.ndarray, hub: np.ndarray, met: np.ndarray) -> tuple[np.ndarray, ...]:
    """(a, b, votes, asks) of the pairs of places hub and met; hubs ask for less."""
    order = np.lexsort((row[met], row[hub]))
    hub, met = hub[order], met[order]
    new = np.flatnonzero(np.concatenate([[True], (row[hub][1:] != row[hub][:-1]) | (row[met][1:] != row[met][:-1])])) if len(hub) else np.zeros(0, np.int64)
    return row[hub[new]], row[met[new]], np.diff(np.append(new, len(hub))), asks[hub[new]]


_MET = "block long, entry long, a long, b long, votes int, asks int"


def _met(block: int, pairs: tuple[np.ndarray, ...], entry: np.ndarray, row: np.ndarray, asks: np.ndarray) -> pa.Table:
    """Pairs, where entry is null, and the images of entries that are left, where b is null."""
    none = lambda x: pa.nulls(len(x), pa.int64())
    a, b, votes, least = pairs
    return pa.table([
        pa.array([block] * (len(a) + len(row)), pa.int64()), pa.concat_arrays([none(a), pa.array(entry)]), pa.array(np.concatenate([a, row])), pa.concat_arrays([pa.array(b), none(row)]),
        pa.array(np.concatenate([votes, np.zeros(len(row), np.int64)]).astype(np.int32)), pa.array(np.concatenate([least, asks]).astype(np.int32)),
    ], names=["block", "entry", "a", "b", "votes", "asks"]).combine_chunks()


def met_in_blocks(packed: DataFrame, least: int, share: float) -> DataFrame:
    """(block, entry, a, b, votes, asks): votes of pairs, where entry is null, of entries of FEW images at most and of the HUBS
    smallest images of others; and the rest of these as (entry, a, asks), where b is null."""

    def of(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        read = lambda name, kind: [_spread_out(x, kind) for x in table.column(name).to_pylist()]
        rows = [np.cumsum(x) for x in read("rows", "<i8")]
        begin = np.cumsum([0, *map(len, rows)])
        row, n = np.concatenate(rows), np.concatenate(read("sizes", "<i8"))
        asks = asked(n, least, share)
        by_size = np.lexsort((row, asks))
        rank = np.empty(len(row), np.int64)
        rank[by_size] = np.arange(len(row))
        row, asks = row[by_size], asks[by_size]
        held = np.concatenate([np.cumsum(e.astype(np.int64)) << 32 | rank[k + p] for e, p, k in zip(read("entries", "<u4"), read("places", "<u2"), begin, strict=False)])
        held = np.sort(held.view(np.uint64))
        entry, image = (held >> np.uint64(32)).astype(np.int64), (held & np.uint64(0xFFFFFFFF)).astype(np.int64)
        place, size = _groups(entry)
        some = size > 1
        entry, image, place, size = entry[some], image[some], place[some], size[some]
        met = [np.flatnonzero((place > k) & ((size <= FEW) | (k < HUBS))) for k in range(FEW - 1)]
        pair = np.concatenate([image[x - place[x] + k] << 32 | image[x] for k, x in enumerate(met)])
        pair, votes = np.unique(pair, return_counts=True)
        a, b = pair >> 32, pair & 0xFFFFFFFF
        rest = np.flatnonzero((size > FEW) & (place >= HUBS))
        return _met(key[0].as_py(), (row[a], row[b], votes, asks[a]), entry[rest], row[image[rest]], asks[image[rest]])

    return packed.groupBy("block").applyInArrow(of, _MET)


def met_again(open_: DataFrame, hubs: int) -> DataFrame:
    """As met_in_blocks() of the entries (block, entry, row, asks, component, able) that are open, by their first hubs images."""

    def of(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        entry, row, asks, component = (table.column(c).to_numpy().astype(np.int64) for c in ("entry", "row", "asks", "component"))
        able = table.column("able").to_numpy()
        order = np.lexsort((row, asks, entry))
        entry, row, asks, component, able = entry[order], row[order], asks[order], component[order], able[order]
        place, _ = _groups(entry)
        meets = np.minimum(place, hubs)
        for at in np.split(np.arange(len(row)), np.flatnonzero(np.diff(np.cumsum(meets) // (2 * VOTES))) + 1):
            n = meets[at]
            met = np.repeat(at, n)
            hub = met - place[met] + np.arange(len(met)) - np.repeat(np.cumsum(n) - n, n)
            good = (component[met] != component[hub]) & (able[met] | able[hub])
            yield from _met(key[0].as_py(), _votes(row, asks, hub[good], met[good]), *(np.zeros(0, np.int64),) * 3).to_batches()
        rest = place >= hubs
        yield from _met(key[0].as_py(), (np.zeros(0, np.int64),) * 4, entry[rest], row[rest], asks[rest]).to_batches()

    return open_.select("block", "entry", "row", "asks", "component", "able").groupBy("block").applyInArrow(of, _MET)


def judged(pairs: DataFrame, sets: DataFrame, least: int, share: float, heavy: int) -> DataFrame:
    """The (a, b) of pairs whose images (row, corners, strings) are linked."""
    if pairs.count() <= MOST_HELD:  # only images of pairs are shuffled
        sets = sets.join(F.broadcast(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()), "row", "left_semi")
    left = spread_join(pairs, sets.select(F.col("row").alias("a"), F.col("corners").alias("ca"), F.col("strings").alias("sa")), "a", ["b"], heavy)
    both = left.join(sets.select(F.col("row").alias("b"), F.col("corners").alias("cb"), F.col("strings").alias("sb")), "b").select("a", "b", "ca", "sa", "cb", "sb")

    def compared(batches):
        for batch in batches:
            good, some, size = [], [], 0
            blobs = zip(*(batch.column(c).to_pylist() for c in ("ca", "sa", "cb", "sb")), strict=True)
            for k, (ca, sa, cb, sb) in enumerate(blobs):
                some.append((unpacked_corners(ca)[0], np.frombuffer(sa, dtype="<u8"), unpacked_corners(cb)[0], np.frombuffer(sb, dtype="<u8")))
                size += len(sa) + len(sb)
                if size > 200_000 or k == len(batch) - 1:
                    m, n = (np.array([len(x[i]) for x in some]) for i in (1, 3))
                    good.append(agreeing_in(some) >= needed(m, n, least, share))
                    some, size = [], 0
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(np.concatenate(good) if good else [], pa.bool_()))

    return both.mapInArrow(compared, "a long, b long")


def joined(links: DataFrame) -> DataFrame:
    """components() of links, found on the driver while they are few."""
    if links.count() > MOST_HELD:
        return Stored(components(links)).df
    ends = links.toArrow()
    nodes, ends = np.unique(np.concatenate([ends.column(c).to_numpy() for c in ("a", "b")]), return_inverse=True)
    a, b = ends.reshape(2, -1)
    label, after = None, np.arange(len(nodes))
    while label is None or (after != label).any():
        label = after
        after = label.copy()
        low = np.minimum(label[a], label[b])
        for end in (a, b):
            np.minimum.at(after, label[end], low)
            np.minimum.at(after, end, low)
        after = after[after]
    found = pa.table({"node": pa.array(nodes, pa.int64()), "component": pa.array(nodes[after] if len(nodes) else nodes, pa.int64())})
    return F.broadcast(links.sparkSession.createDataFrame(found))


def described(images: DataFrame) -> DataFrame:
    """(id, same, whole, n, corners, strings) of images; same is a digest. Equal images of a task are described once."""
    kind = images.schema["id"].dataType.simpleString()
    same = F.unhex(F.sha2(F.concat(F.coalesce(F.col("width").cast("string"), F.lit("")).cast("binary"), F.lit(":").cast("binary"), F.coalesce("pixels", F.lit(b""))), 256))

    def of(batches):
        known: dict[bytes, tuple[int, bytes, bytes]] = {}
        for batch in batches:
            for part in in_parts(batch, "pixels"):
                same, width, pixels = (part.column(c).to_pylist() for c in ("same", "width", "pixels"))
                whole = [bool(p) and bool(w) and w > 0 and len(p) % w == 0 for w, p in zip(width, pixels, strict=True)]
                new = {s: np.frombuffer(p, dtype=np.uint8).reshape(-1, w) if good else np.zeros((0, 1), np.uint8) for s, w, p, good in zip(same, width, pixels, whole, strict=True) if s not in known}
                if len(known) > 2000:
                    known = {s: known[s] for s in same if s in known}
                for s, (corners, strings, around) in zip(new, describe_all(list(new.values())), strict=True):
                    known[s] = len(strings), packed_corners(corners, around), strings.tobytes()
                n, corners, strings = zip(*(known[s] for s in same), strict=True)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("same"), pa.array(whole, pa.bool_()), pa.array(n, pa.int32()), pa.array(corners, pa.binary()), pa.array(strings, pa.binary())], ["id", "same", "whole", "n", "corners", "strings"])

    return images.select("id", same.alias("same"), "width", "pixels").mapInArrow(of, f"id {kind}, same binary, whole boolean, n int, corners binary, strings binary")


def find_copies(images: DataFrame, least: int = 8, share: float = 0.5) -> DataFrame:
    """(id, class_id, n_corners, kept) of images (id, width, pixels).

    Two images are linked if at least `least` corners (in images of few: see needed()), and at least `share` of the corners of the one with
    fewer, agree.
    """
    seen = Stored(described(images).withColumn("row", F.monotonically_increasing_id())).df
    firsts = Stored(seen.where(F.col("id").isNotNull() & F.col("whole")).groupBy("same").agg(F.min("id").alias("least_id"), F.min("row").alias("row"), F.max("n").alias("n"))).df
    corners = firsts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    heavy = heavy_from(2 * corners)
    sets = seen.where(F.col("n") >= FEWEST).select("row", "n", "corners", "strings")
    others = Stored(sets.select("row").join(firsts.select("row"), "row", "left_anti")).df
    if n := others.count():  # not every row is the first of its equals
        sets = sets.join(F.broadcast(others) if n <= MOST_HELD else others, "row", "left_anti")
    met = Stored(met_in_blocks(blocks(sets, max(12, 2 * corners // BLOCK)), least, share)).df
    enough = lambda met: met.where("entry IS NULL").groupBy("a", "b", "asks").agg(F.sum("votes").alias("votes")).where("votes >= asks").select("a", "b")
    tested = Stored(enough(met)).df
    links = Stored(judged(tested, sets, least, share, heavy)).df
    part = joined(links)
    left = lambda met: met.where("b IS NULL").select("block", "entry", F.col("a").alias("row"), "asks")
    rest, hubs = left(met), HUBS
    few = rest.count() <= MOST_HELD
    of_keys = lambda many, one, key, by: many.join(F.broadcast(one), key) if few else spread_join(many, one, key, by, heavy)
    while True:
        hubs *= 8
        placed = rest.join(part.withColumnRenamed("node", "row"), "row", "left").withColumn("component", F.coalesce("component", "row"))
        mixed = placed.groupBy("block", "entry").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
        key = F.struct("block", "entry")
        placed = Stored(of_keys(placed.withColumn("key", key), mixed.select(key.alias("key")), "key", ["row"])).df
        # an image can still be linked as the smaller one if enough of its entries are open
        able = placed.groupBy("row").agg(F.count("*").alias("m"), F.min("asks").alias("asks")).where("m >= asks").select("row", F.lit(True).alias("able"))
        placed = placed.join(F.broadcast(able) if few else able, "row", "left").withColumn("able", F.coalesce("able", F.lit(False)))
        asking = placed.groupBy("key").agg(F.max("able").alias("any")).where("any").select("key")
        open_ = Stored(of_keys(placed, asking, "key", ["row"]).drop("key")).df
        if not open_.limit(1).count():
            break
        met = Stored(met_again(open_, hubs)).df
        new = Stored(enough(met).join(tested, ["a", "b"], "left_anti")).df
        if new.limit(1).count():
            links = links.union(Stored(judged(new, sets, least, share, heavy)).df)
            part = joined(links)
            tested = tested.union(new)
        rest = left(met)
    of_image = firsts.join(part.withColumnRenamed("node", "row"), "row", "left").select("same", "least_id", "n", F.coalesce("component", "row").alias("class_row"))
    classes = of_image.groupBy("class_row").agg(F.min("least_id").alias("class_id"))
    named = spread_join(of_image.drop("least_id"), classes, "class_row", ["same"], heavy)
    out = spread_join(seen.select("id", "same", "whole", "row"), named.select("same", "n", "class_id"), "same", ["row"], heavy, "left")
    alone = F.col("id").isNull() | ~F.col("whole")
    return out.select("id", F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_corners")).withColumn("kept", F.col("id").eqNullSafe(F.col("class_id")))
