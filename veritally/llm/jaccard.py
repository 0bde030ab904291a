"""N-gram Jaccard join by signature trees.

A document is the set of its distinct word shingles. Two documents link when
``100 * intersection >= threshold * union``. The join finds which documents are connected by links.

Sets that are equal are one class, known by a 64-bit fingerprint, so copies are never compared. Then:

1.  **Routing.** A set is cut by hash into parts of 64 to 127 shingles. If two sets link, so do two of their parts with the
    same number: a ratio of sums is never above all ratios of the summands. Each part goes to one bucket per shingle of
    its prefix, so parts that link share a bucket. Common shingles come last in the order, by counts over all
    documents in a table of fixed size; the most common ones get no bucket but connect all that have them.
2.  **Trees in buckets.** A bucket's parts, each with size and token bitmap, form a signature tree; its dual traversal leaves the pairs
    that can reach the threshold. Connected by these, classes fall into groups: any two that link are in one group.
3.  **Trees in groups.** The whole sets of a group form a signature tree with wider bitmaps. A pair of nodes is left out if its
    maximum possible overlap is too small, or if all documents below are connected already; what remains is
    compared exactly. A large group is cut at random, twice, into chunks; then documents outside the
    group's largest connected part are cut into pieces, and so is that part. Pieces meet in pairs, so no link is lost
    and no tree holds more than two pieces.

A node has the OR of the bitmaps below it, the range of sizes, and the most shingles that share bits. NULL and empty texts have no
shingle and link with nothing. Rows that repeat a doc_id count as documents of their own under the
same name. Hashes stand for words and shingles (64 bits).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import BITMAP_BITS, bitmap_of, drop_listed, in_arrow, is_small, mix64, sliced, texts_of, unused_name
from veritally.llm.components import components
from veritally.workspace import materialize

PART = 64  # shingles of a part at least, unless the set is smaller; twice that at most
CELLS = 1 << 18  # of the table of shingle counts
HOT_ROWS = 4_096  # a shingle is common if its cell has this many documents and HOT_TIMES the mean
HOT_TIMES = 4
SMALL_RUN = 16  # parts of a bucket up to which all pairs are looked at without a tree
LARGE_RUN = 8_192  # parts of a bucket beyond which all of them are connected without a look
LEAF = 16
FAN = 4
CHUNK_DOCS = 2_048
CHUNK_SHINGLES = 4 << 20
MAX_WORDS = 128  # of 64 bits in the bitmap of a whole set

_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.ones(1, dtype=np.uint64)
    up = np.concatenate((one, np.full(size, _BASE))).cumprod(dtype=np.uint64)
    down = np.concatenate((one, np.full(size, _INVERSE))).cumprod(dtype=np.uint64)
    return up, down


def shingle_sets(texts: Iterable[str | None], width: int) -> list[np.ndarray]:
    """For each text its distinct shingles, as sorted 64-bit hashes.

    Word hashes are differences of a running polynomial over all bytes; shingle hashes combine ``width`` of them. A text with
    fewer words has the whole sequence as its one shingle.
    """
    encoded = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    line = np.frombuffer(b" " + b" ".join(encoded) + b" ", dtype=np.uint8)
    space = _SPACE[line]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    up, down = _powers(1 << int(len(line)).bit_length())
    running = np.concatenate((np.zeros(1, dtype=np.uint64), (_BYTES[line] * up[: len(line)]).cumsum(dtype=np.uint64)))
    words = mix64((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _STEP)
    size = np.fromiter((len(e) + 1 for e in encoded), dtype=np.int64, count=len(encoded))
    first = np.searchsorted(starts, np.concatenate(([1], 1 + np.cumsum(size))))
    whole = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for j in range(width):
        whole = whole * _STEP + words[j : j + len(whole)]
    whole = mix64(whole + np.uint64(width))
    out = []
    for a, b in zip(first, first[1:]):
        n = int(b - a)
        if n >= width:
            out.append(np.unique(whole[a : b - width + 1]))
        elif n:
            short = np.zeros(1, dtype=np.uint64)
            for w in words[a:b]:
                short = short * _STEP + w
            out.append(mix64(short + np.uint64(n)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def set_fingerprint(shingles: np.ndarray) -> int:
    """One signed 64-bit number for a set; never 0 but for the empty one."""
    if not len(shingles):
        return 0
    total = np.array([mix64(shingles ^ _STEP).sum(dtype=np.uint64)]) + np.array([len(shingles)], dtype=np.uint64) * _BASE
    return int(mix64(total).view(np.int64)[0]) or 1


def _set_batches(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in sliced(batches, "_text"):
        yield batch, shingle_sets(texts_of(batch, "_text"), width)


def _arrow(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


# --- signature trees ---------------------------------------------------------


def bitmaps(sets: list[np.ndarray], words: int) -> np.ndarray:
    """For each set the bits of its shingles, as rows of ``words`` 64-bit words."""
    out = np.zeros((len(sets), words), dtype=np.uint64)
    for row, s in zip(out, sets):
        place = s & np.uint64(words * 64 - 1)
        np.bitwise_or.at(row, (place >> np.uint64(6)).astype(np.intp), np.uint64(1) << (place & np.uint64(63)))
    return out


def _count(bits: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits).sum(axis=-1, dtype=np.int64)


class SignatureTree:
    """Sets by size and bitmap; ``connect`` merges the labels of those that link.

    Level 0 has one node per ``LEAF`` sets, each further level one per ``FAN`` nodes. Sets are in order of size, those of one size
    in order of their bitmaps, so near copies lie side by side. With ``sides``, sets of one side lie side by side and only
    pairs of different sides count.
    """

    def __init__(self, sizes: np.ndarray, signatures: np.ndarray, threshold: int, sides: np.ndarray | None = None):
        self.threshold = threshold
        self.order = np.lexsort((*signatures.T[::-1][-2:], sizes) if sides is None else (*signatures.T[::-1][-2:], sizes, sides))
        self.sizes, self.bits = sizes[self.order].astype(np.int64), signatures[self.order]
        self.sides = None if sides is None else sides[self.order]
        self.shared = self.sizes - _count(self.bits)  # shingles without a bit of their own
        self.levels = []
        bits, low, high, shared = self.bits, self.sizes, self.sizes, self.shared
        step = LEAF
        while True:
            cuts = np.arange(0, len(low), step)
            bits = np.bitwise_or.reduceat(bits, cuts, axis=0)
            low, high, shared = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts), np.maximum.reduceat(shared, cuts)
            self.levels.append((bits, low, high, shared))
            if len(low) == 1:
                break
            step = FAN

    def _span(self, level: int, node: int) -> tuple[int, int]:
        width = LEAF * FAN**level
        return node * width, min(len(self.sizes), (node + 1) * width)

    def _possible(self, level: int, x: int, y: np.ndarray) -> np.ndarray:
        """Whether some set below node x can link with one below each of the nodes y, by the maximum possible overlap."""
        bits, low, high, shared = self.levels[level]
        t = self.threshold
        common = _count(bits[x] & bits[y])
        overlap = np.minimum(np.minimum(high[x], shared[x] + common), np.minimum(high[y], shared[y] + common))
        fits = t * np.maximum(low[x], low[y]) <= 100 * np.minimum(high[x], high[y])
        return fits & ((100 + t) * overlap >= t * (low[x] + low[y]))

    def _pairs(self, a: int, b: int, c: int, d: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of sets from a:b and c:d, each once, that pass the same bound by their own bitmaps."""
        t, n, m = self.threshold, self.sizes[a:b, None], self.sizes[None, c:d]
        common = _count(self.bits[a:b, None, :] & self.bits[None, c:d, :])
        overlap = np.minimum(np.minimum(n, self.shared[a:b, None] + common), np.minimum(m, self.shared[None, c:d] + common))
        fits = ((100 + t) * overlap >= t * (n + m)) & (t * np.maximum(n, m) <= 100 * np.minimum(n, m))
        if a == c:
            fits = np.triu(fits, 1)
        if self.sides is not None:
            fits &= self.sides[a:b, None] != self.sides[None, c:d]
        i, j = np.nonzero(fits)
        return i + a, j + c

    def connect(self, labels: np.ndarray, links: Callable[[int, int], bool] | None = None) -> np.ndarray:
        """``labels`` (one number per set) after merging those of all pairs that link; without ``links``, of all that may."""
        label = labels[self.order].copy()
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            level, x, y = stack.pop()
            (a, b), (c, d) = self._span(level, x), self._span(level, y)
            one = label[a]
            if (label[a:b] == one).all() and (label[c:d] == one).all():
                continue
            if self.sides is not None and self.sides[a] == max(self.sides[b - 1], self.sides[d - 1]):
                continue  # x is never after y, so all sets below both are of one side
            if level:
                below = len(self.levels[level - 1][1])
                xs = range(x * FAN, min(below, (x + 1) * FAN))
                ys = np.arange(y * FAN, min(below, (y + 1) * FAN))
                for i in xs:
                    ok = ys[self._possible(level - 1, i, ys)]
                    stack.extend((level - 1, i, int(j)) for j in (ok[ok >= i] if x == y else ok))
                continue
            for i, j in zip(*self._pairs(a, b, c, d)):
                if label[i] != label[j] and (links is None or links(int(self.order[i]), int(self.order[j]))):
                    label[label == label[j]] = label[i]
        out = np.empty_like(label)
        out[self.order] = label
        return out


def _star_edges(ids: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each label an edge from its smallest id to each other one."""
    if not len(ids):
        return ids, ids
    order = np.lexsort((ids, label))
    ids, label = ids[order], label[order]
    head = np.concatenate(([True], label[1:] != label[:-1]))
    least = ids[np.flatnonzero(head)][np.cumsum(head) - 1]
    return least[~head], ids[~head]


def overlap_at_least(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """The exact test on two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if threshold * len(b) > 100 * len(a):
        return False
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    common = int((b[place] == a).sum())
    return 100 * common >= threshold * (len(a) + len(b) - common)


# --- routing -------------------------------------------------------------------


def _parts_of(n: int) -> int:
    return 1 << max(0, (n // PART).bit_length() - 1)


def part_counts(n: int, threshold: int) -> list[int]:
    """Into how many parts a set of ``n`` is cut: as many as it and each smaller set that can link to it by themselves call for."""
    counts = [_parts_of(-(-threshold * n // 100))]
    while counts[-1] < _parts_of(n):
        counts.append(2 * counts[-1])
    return counts


def _routed_most(sets: int, shingles: int, threshold: int) -> int:
    """A number that the rows of ``_route`` do not exceed, for so many sets with so many shingles in all: for each part count the
    prefixes of the parts, of which a set has one, or one per ``PART`` shingles."""
    counts = 1 + (-(-100 // threshold) - 1).bit_length()
    return counts * (shingles * (100 - threshold) // 100 + shingles // PART + sets)


def _count_cells(docs: DataFrame, width: int, total: int) -> np.ndarray:
    """How common the shingles of each cell are: 0, or 1 and up for cells with many more documents than the mean.

    Counts run over all documents, whose sets have ``total`` shingles in all; the driver gets the cells above a multiple of the
    mean, at most ``CELLS / HOT_TIMES``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, dtype=np.int64)
        for _, sets in _set_batches(batches, width):
            cells = np.concatenate(sets) & np.uint64(CELLS - 1)
            counts += np.bincount(cells.astype(np.intp), minlength=CELLS)
        at = np.flatnonzero(counts)
        for k in range(0, len(at), 1 << 16):
            some = at[k : k + (1 << 16)]
            yield _arrow(cell=some.astype(np.int32), n=counts[some])

    cells = in_arrow(docs, run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    least = max(HOT_ROWS, HOT_TIMES * total / CELLS)
    hot = cells.where(F.col("n") >= least).toArrow()
    level = np.zeros(CELLS, dtype=np.uint8)
    level[hot["cell"].to_numpy()] = 1 + np.log2(hot["n"].to_numpy() / least).astype(np.uint8)
    return level


def part_rows(shingles: np.ndarray, threshold: int, level: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, hot, size, bits0, bits1) of the prefix of every part of a set."""
    n = len(shingles)
    out = []
    commonness = level[(shingles & np.uint64(CELLS - 1)).astype(np.intp)]
    for k in part_counts(n, threshold):
        shift = np.uint64(65 - k.bit_length())
        part = (shingles >> shift).astype(np.intp) if k > 1 else np.zeros(n, dtype=np.intp)
        size = np.bincount(part, minlength=k)
        begin = np.concatenate(([0], np.cumsum(size)[:-1]))
        filled = np.flatnonzero(size)
        bit = mix64(shingles)
        one = np.uint64(1) << (bit & np.uint64(63))
        upper = (bit & np.uint64(64)) != 0
        bits = [np.zeros(k, dtype=np.uint64) for _ in range(2)]
        for word, mask in zip(bits, (~upper, upper)):
            word[filled] = np.bitwise_or.reduceat(np.where(mask, one, np.uint64(0)), begin[filled])
        if commonness.any():
            order = np.lexsort((shingles, commonness, part))
        else:
            order = np.arange(n)
        rank = np.arange(n) - np.repeat(begin, size)
        prefix = size - (threshold * size + 99) // 100 + 1
        chosen = rank < np.repeat(prefix, size)
        token, at = shingles[order][chosen], part[order][chosen]
        key = mix64(token + np.full(len(token), k, dtype=np.uint64) * _STEP)
        out.append((key.view(np.int64), commonness[order][chosen] > 0, size[at].astype(np.int32), bits[0][at].view(np.int64), bits[1][at].view(np.int64)))
    return tuple(np.concatenate(c) for c in zip(*out))


def _route(docs: DataFrame, width: int, threshold: int, level: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # classes of this task: at most one number per row
        for _, sets in _set_batches(batches, width):
            rows, ids = [], []
            for s in sets:
                fp = set_fingerprint(s)
                if fp and fp not in seen:
                    seen.add(fp)
                    rows.append(part_rows(s, threshold, shared.value))
                    ids.append(np.full(len(rows[-1][0]), fp, dtype=np.int64))
            if rows:
                key, hot, size, bits0, bits1 = (np.concatenate(c) for c in zip(*rows))
                yield _arrow(key=key, hot=hot, class_id=np.concatenate(ids), size=size, bits0=bits0, bits1=bits1)

    return in_arrow(docs, run, "key long, hot boolean, class_id long, size int, bits0 long, bits1 long")


def _small_runs(begin: np.ndarray, length: np.ndarray, ids: np.ndarray, size: np.ndarray, bits: np.ndarray, threshold: int):
    """Star edges of many short runs at once, all pairs of a run looked at."""
    firsts, seconds = [], []
    for n in np.unique(length):
        i, j = np.triu_indices(int(n), 1)
        start = begin[length == n][:, None]
        firsts.append((start + i).ravel())
        seconds.append((start + j).ravel())
    a, b = np.concatenate(firsts), np.concatenate(seconds)
    common = _count(bits[a] & bits[b])
    shared = size - _count(bits)
    overlap = np.minimum(np.minimum(size[a], shared[a] + common), np.minimum(size[b], shared[b] + common))
    ok = ((100 + threshold) * overlap >= threshold * (size[a] + size[b])) & (
        threshold * np.maximum(size[a], size[b]) <= 100 * np.minimum(size[a], size[b])
    )
    a, b = a[ok], b[ok]
    label = np.arange(len(ids))
    while True:  # within a run at most SMALL_RUN rounds
        least = np.minimum(label[a], label[b])
        if (label[a] == least).all() and (label[b] == least).all():
            break
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
    touched = np.unique(np.concatenate((a, b)))
    return _star_edges(ids[touched], label[touched])


def _bucket_edges(rows: DataFrame, threshold: int, large_run: int = LARGE_RUN) -> DataFrame:
    """Edges between classes whose parts share a bucket and may link; common shingles are vertices of their own."""
    route = F.when(F.col("hot"), F.xxhash64("key", "class_id")).otherwise(F.col("key"))
    sorted_rows = rows.withColumn("route", route).repartition("route").sortWithinPartitions("hot", "key", "class_id")

    def edges_of(key, ids, size, bits):
        """Edges of complete runs of equal keys."""
        keep = np.concatenate(([True], (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])))
        key, ids, size, bits = key[keep], ids[keep], size[keep].astype(np.int64), bits[keep]
        cuts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
        begin, length = cuts[:-1], np.diff(cuts)
        short = (length > 1) & (length <= SMALL_RUN)
        if short.any():
            yield _small_runs(begin[short], length[short], ids, size, bits, threshold)
        for a, n in zip(begin[length > SMALL_RUN], length[length > SMALL_RUN]):
            label = np.zeros(n, dtype=np.int64)
            if n <= large_run:
                label = SignatureTree(size[a : a + n], bits[a : a + n], threshold).connect(np.arange(n))
            yield _star_edges(ids[a : a + n], label)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple | None = None  # the last run, which may go on in the next batch
        wide = None  # the key and the first class of a run of which all are connected
        for batch in batches:
            if not batch.num_rows:
                continue
            hot = batch.column("hot").to_numpy(zero_copy_only=False)
            key, ids, size, bits0, bits1 = (batch.column(c).to_numpy() for c in ("key", "class_id", "size", "bits0", "bits1"))
            if hot.any():
                yield _arrow(a=key[hot], b=ids[hot])
            cold = ~hot
            now = (key[cold], ids[cold], size[cold], np.stack((bits0[cold], bits1[cold]), axis=1).view(np.uint64))
            if kept is not None:
                now = tuple(np.concatenate(c) for c in zip(kept, now))
            if wide is not None:
                same = now[0] == wide[0]
                yield _arrow(a=np.full(int(same.sum()), wide[1]), b=now[1][same])
                now = tuple(c[~same] for c in now)
            if not len(now[0]):
                kept = None
                continue
            end = int(np.searchsorted(now[0], now[0][-1]))
            for a, b in edges_of(*(c[:end] for c in now)) if end else ():
                yield _arrow(a=a, b=b)
            kept = tuple(c[end:] for c in now)
            if len(kept[0]) > large_run:
                wide = kept[0][0], kept[1][0]
                yield _arrow(a=np.full(len(kept[1]), wide[1]), b=kept[1])
                kept = None
        if kept is not None and len(kept[0]):
            for a, b in edges_of(*kept):
                yield _arrow(a=a, b=b)

    return in_arrow(sorted_rows.select("hot", "key", "class_id", "size", "bits0", "bits1"), run, "a long, b long")


# --- exact links -----------------------------------------------------------------


def _candidate_sets(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(class_id, shingles) of the documents whose class may be among ``classes``, by a bitmap of fixed size. One task
    gives each class once; several tasks may repeat it."""
    bitmap = bitmap_of(classes, "class_id", BITMAP_BITS)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap.view(np.uint64))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets in _set_batches(batches, width):
            ids, lines = [], []
            for s in sets:
                fp = set_fingerprint(s)
                places = ((fp >> shift) % BITMAP_BITS for shift in (0, 32))
                if fp and fp not in seen and all(int(shared.value[p >> 6]) >> (p & 63) & 1 for p in places):
                    seen.add(fp)
                    ids.append(fp)
                    lines.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lines, pa.binary())], names=["class_id", "shingles"])

    return in_arrow(docs, run, "class_id long, shingles binary")


def _group_edges(rows: DataFrame, threshold: int) -> DataFrame:
    """Edges between the classes of each tree: rows are (tree, side, class_id, label, shingles), those of a tree side by side. In
    a tree with sides other than 0, only classes of different sides are compared."""

    def edges_of(ids: list[int], sides: list[int], labels: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        side = np.array(sides, dtype=np.int8)
        label = np.unique(np.array(labels, dtype=np.int64), return_inverse=True)[1]
        sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
        words = min(MAX_WORDS, 1 << max(0, int(np.median(sizes) * 2 // 64).bit_length()))
        tree = SignatureTree(sizes, bitmaps(sets, words), threshold, side if side.any() else None)
        found = tree.connect(label, lambda i, j: overlap_at_least(sets[i], sets[j], threshold))
        a, b = _star_edges(np.array(ids, dtype=np.int64), found)
        return _arrow(a=a, b=b)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, last, ids, sides, labels, sets = None, None, [], [], [], []
        for batch in sliced(batches, "shingles"):
            for t, d, i, n, s in zip(*(batch.column(c).to_pylist() for c in ("tree", "side", "class_id", "label", "shingles"))):
                if t != tree:
                    if len(ids) > 1:
                        yield edges_of(ids, sides, labels, sets)
                    tree, last, ids, sides, labels, sets = t, None, [], [], [], []
                if i != last:  # a class that several tasks gave
                    last = i
                    ids.append(i)
                    sides.append(d)
                    labels.append(n)
                    sets.append(np.frombuffer(s, dtype=np.uint64))
        if len(ids) > 1:
            yield edges_of(ids, sides, labels, sets)

    placed = rows.select("tree", "side", "class_id", "label", "shingles").repartition("tree").sortWithinPartitions("tree", "class_id")
    return in_arrow(placed, run, "a long, b long")


def _pieces(chunk_docs: int) -> Column:
    """Into how many pieces a set of documents is cut, by their number ``n`` and their shingles ``s``."""
    return F.greatest(F.ceil(F.col("n") / chunk_docs), F.ceil(F.col("s") / CHUNK_SHINGLES)).cast("int")


def _meetings(piece: Column, pieces: Column, rest: Column, apart: Column) -> Column:
    """The trees of a document as (first, second, side): two pieces of documents that are apart, or one of them and one of the
    rest, which is numbered from -1 down. Each pair of pieces has one tree."""
    meet = lambda i, j, side: F.struct(i.alias("first"), j.alias("second"), side.cast("int").alias("side"))
    side = lambda j: F.when(piece == j, F.lit(0)).when(piece < j, F.lit(1)).otherwise(F.lit(2))
    each = lambda n: F.sequence(F.lit(0), n - 1)
    with_apart = F.transform(each(pieces), lambda j: meet(F.least(piece, j), F.greatest(piece, j), side(j)))
    with_rest = F.transform(each(rest), lambda j: meet(piece, -1 - j, F.lit(1)))
    of_rest = F.transform(each(pieces), lambda i: meet(i, -1 - piece, F.lit(2)))
    return F.when(apart, F.concat(with_apart, with_rest)).otherwise(of_rest)


def _links(
    docs: DataFrame, sizes: DataFrame, groups: DataFrame, width: int, threshold: int, chunk_docs: int, most: int
) -> tuple[DataFrame, int]:
    """Verified edges that connect exactly the classes that links connect, and a number that they do not exceed; there are ``most``
    classes or fewer."""
    members = sizes.join(groups.withColumnsRenamed({"node": "class_id", "component": "group"}), "class_id")
    load = F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s")
    loads = members.groupBy("group").agg(*load).where("n > 1").select("group", _pieces(chunk_docs).alias("chunks"))
    members = materialize(members.select("class_id", "group", "n_shingles").join(loads, "group"), "members", most)
    listed = members.drop("n_shingles")
    sets = _candidate_sets(docs, listed, width).join(F.broadcast(listed) if is_small(listed) else listed, "class_id")
    sets = materialize(sets, "sets")
    rounds = F.when(F.col("chunks") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    chunk = lambda r, n: F.pmod(F.xxhash64("class_id", r), n).cast("int")
    dealt = sets.withColumn("round", F.explode(rounds))
    dealt = dealt.withColumn("tree", F.xxhash64("group", "round", chunk(F.col("round"), F.col("chunks"))))
    dealt = dealt.withColumns({"side": F.lit(0), "label": F.col("class_id")})
    found = _group_edges(dealt, threshold)  # a class has one edge in a tree at most, and two rounds
    large = sets.where("chunks > 1")
    if large.isEmpty():
        return found, 2 * most
    found = materialize(found.distinct(), "links", 2 * most)

    # Documents that are not in the largest connected part of a large group meet each other and that part.
    parts = components(found, 2 * most).withColumnsRenamed({"node": "class_id", "component": "label"})
    labelled = members.where("chunks > 1").join(parts, "class_id", "left").withColumn("label", F.coalesce("label", "class_id"))
    counts = labelled.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("group").agg(F.max_by("label", F.struct("n", "label")).alias("largest"))
    labelled = labelled.join(largest, "group").withColumn("apart", F.col("label") != F.col("largest"))
    labelled = materialize(labelled.select("class_id", "group", "n_shingles", "label", "apart"), "labelled", most)
    loads = labelled.groupBy("group", "apart").agg(*load).withColumn("k", _pieces(chunk_docs)).groupBy("group")
    of = lambda c, apart: F.max(F.when(F.col("apart") == F.lit(apart), F.col(c)))
    loads = loads.agg(of("k", True).alias("pieces"), of("k", False).alias("rest"), of("n", True).alias("n"), of("n", False).alias("m"))
    loads = loads.where("pieces > 0")
    met = loads.agg(F.sum(F.expr("n * (pieces + rest) + m * pieces")).alias("met")).first()["met"]
    if met is None:
        return found, 2 * most
    loads = loads.drop("n", "m")
    own = F.when(F.col("apart"), F.col("pieces")).otherwise(F.col("rest"))
    again = labelled.join(loads, "group").select("class_id", "label", "pieces", "rest", "apart", chunk(F.lit(2), own).alias("piece"))
    meetings = F.explode(_meetings(F.col("piece"), F.col("pieces"), F.col("rest"), F.col("apart")))
    again = large.join(again, "class_id").withColumn("meeting", meetings).select("*", "meeting.*")
    more = _group_edges(again.withColumn("tree", F.xxhash64("group", "first", "second")), threshold)
    return found.unionByName(more), 2 * most + met


def jaccard_components(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    width: int = 5,
    threshold: int = 80,
    chunk_docs: int = CHUNK_DOCS,
    large_run: int = LARGE_RUN,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, n_shingles, component_id, component, *keep) of every row: ``component_id`` is the smallest doc_id reachable by
    links, ``component`` the same as a hash that is there without doc_ids as well; ``keep`` names long columns to carry along.

    ``threshold`` is a percentage from 1 to 100, and results are complete at each. A set is routed once per part count that a partner may
    have: once or twice from 50 on, up to seven times at 1, with more candidates each time.
    """
    if not 1 <= threshold <= 100:
        raise ValueError(f"a threshold of {threshold} percent")
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), *keep, F.col(text).alias("_text"))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _set_batches(batches, width):
            fingerprints = pa.array([set_fingerprint(s) for s in sets], pa.int64())
            counts = pa.array([len(s) for s in sets], pa.int64())
            arrays = [*(batch.column(c) for c in ("doc_id", *keep)), counts, fingerprints]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *keep, "n_shingles", "class_id"])

    schema = ", ".join(f"`{c}` long" for c in ("doc_id", *keep, "n_shingles", "class_id"))
    rows = materialize(in_arrow(texts, measure, schema), "classes")
    only_text = texts.select("_text")
    figures = rows.where("n_shingles > 0").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("s")).first()
    routed = _route(only_text, width, threshold, _count_cells(only_text, width, figures["s"]))
    groups = components(_bucket_edges(routed, threshold, large_run), _routed_most(figures["n"], figures["s"], threshold))
    sizes = rows.where("n_shingles > 0").groupBy("class_id").agg(F.first("n_shingles").alias("n_shingles"))
    linked = components(*_links(only_text, sizes, groups, width, threshold, chunk_docs, figures["n"]))
    named = linked.withColumnsRenamed({"node": "class_id"})
    labelled = rows.where("n_shingles > 0").join(named, "class_id", "left").withColumn("component", F.coalesce("component", "class_id"))
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    full = labelled.join(least, "component").select("doc_id", "n_shingles", "component_id", "component", *keep)
    alone = F.col("doc_id").alias("component_id"), F.col("class_id").alias("component")
    empty = rows.where("n_shingles = 0").select("doc_id", "n_shingles", *alone, *keep)
    return full.unionByName(empty)


def keep_representatives(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, threshold: int = 80) -> DataFrame:
    """One row of each group of connected documents, all columns as they are: one with the smallest key. Rows without
    a shingle stay.

    Rows are told apart by a hash of key and text. Those to be dropped are listed, and only rows that may be on the list are
    joined with it; of rows that are repeated as they are, one stays.
    """
    name = unused_name(docs, "_row")
    marked = docs.withColumn(name, F.xxhash64(F.col(key), F.col(text)))
    found = jaccard_components(marked, text, key, width, threshold, keep=(name,)).where("n_shingles > 0")
    found = materialize(found.select("component", "doc_id", F.col(name).alias("row")), "found")
    first = F.min_by("row", F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    groups = found.groupBy("component").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    most = found.count()
    members = materialize(found.join(groups, "component").select(F.col("row").alias(name), "first"), "members", most)
    kept = drop_listed(marked, members.where(F.col(name) != F.col("first")).select(name), name)
    repeated = members.where(F.col(name) == F.col("first")).groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = materialize(repeated.select(name), "repeated", most)
    if not repeated.isEmpty():
        columns = [F.col(f"`{c}`") for c in docs.columns]
        several = kept.join(repeated, name, "left_semi").groupBy(name).agg(F.first(F.struct(*columns)).alias("one"))
        return drop_listed(kept, repeated, name).select(*columns).unionByName(several.select("one.*"))
    return kept.drop(name)


def document_components(docs: DataFrame) -> DataFrame:
    """Four-word shingles at 85 % over all ``documents``."""
    return jaccard_components(docs, width=4, threshold=85).select("doc_id", "n_shingles", "component_id")
