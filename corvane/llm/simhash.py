"""SimHash near-dedup with a bit-sliced comparison.

Each text becomes a 64-bit fingerprint of its word shingles. Equal fingerprints
are collapsed first, so that groups of copies weigh one row each. For a small
radius any two fingerprints within it agree in at least ``blocks - radius`` of
``blocks`` bit blocks, so each is dealt out under every choice of that many
blocks. A wide radius, as texts with a fifth of their shingles changed need,
leaves no such blocks; there fingerprints are dealt out by bands of a one-pass
minimum sketch of the same shingle hashes. Either way those that share a key are
compared: the bucket's bits are stored
as vertical planes, one word for 64 fingerprints, the distances of a whole bucket
to one fingerprint are summed plane by plane in carry-save counters, and a block
of 64 is abandoned once all of its counters exceed the radius. Within a bucket
the search runs breadth first and drops what it has reached, so a dense group
costs little more than its size, and it gives a spanning tree, never all pairs.
Trees are joined to components by alternating star contraction.

The wide search only finds candidates: what it connects is then compared by the
exact Jaccard similarity of the sets of shingle hashes, inside each of its
components, and only links of SIMILAR or more make the final components. Texts
with the same set are collapsed first. A component of more than GROUP different
texts is cut into blocks that meet pair by pair, so a task holds 2 * GROUP sets at
most, at the price of so many more of them as there are blocks; a bucket of more
than BUCKET fingerprints likewise.

Hot keys, such as the fingerprint of empty texts or the root of a large component,
are joined by broadcast; HOT_KEYS bounds their number.

Edge cases: a text without words (null, empty, white space) has fingerprint zero
and is linked like any other. Fewer words than a shingle make one shingle of all
of them. For the wide search a word is a run of letters, digits and whatever is
beyond ASCII; a text of punctuation alone has its runs of anything but space for
words, so that it is like no empty text. Repeated rows share a fingerprint. A component without any non-null id
has a null component id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.llm.common import append_columns, col, discard, fresh, in_pairs, join_skewed, map_rows, small_slices, texts, written

SHINGLE = 4
RADIUS = 4
#: Least Jaccard similarity of near copies where the radius is wide, as a fraction.
SIMILAR = (4, 5)
#: Bit blocks of a fingerprint; 6 of them, 2 agreeing, make 15 keys of about 21 bits.
BLOCKS = 6
SEED = 42
#: Bands and rows of the sketch that deals out where the radius is wide: texts with a Jaccard similarity of 0.8 share a band
#: but for one pair in thousands.
BANDS, ROWS = 20, 5
#: Shingles of five words. The fingerprints of two sets with a similarity of 0.8 differ in 9.7 bits, give or take 2.9,
#: so that but a few pairs in a hundred thousand exceed this radius.
WIDE_SHINGLE, WIDE_RADIUS = 5, 22
#: Texts of a component, and fingerprints of a bucket, that one task compares; more go in pairs of blocks.
GROUP, BUCKET = 512, 1 << 14

#: A-Z become a-z, and every byte that is no letter or digit, nor part of anything beyond ASCII, becomes a space.
_FOLD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 0x80 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def folded_words(text: bytes | None) -> list[bytes]:
    """Words for the wide search."""
    return (text.translate(_FOLD).split() or text.split()) if text else []


def shingle_hashes(text: bytes | None, shingle: int = SHINGLE, folded: bool = False) -> np.ndarray:
    """XXH64 of the word shingles, repeats included; of all words where they are fewer."""
    ws = folded_words(text) if folded else text.lower().split() if text else []
    if not ws:
        return np.zeros(0, dtype="<u8")
    digest = xxhash.xxh64_intdigest
    line = b" ".join(ws)
    if len(ws) <= shingle:
        return np.array([digest(line, SEED)], dtype="<u8")
    ends = list(accumulate(len(w) + 1 for w in ws))
    starts = [0, *ends[: len(ws) - shingle]]
    return np.array([digest(line[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :])], dtype="<u8")


def fold(hashes: np.ndarray) -> int:
    """The fingerprint: each bit is 1 if it is set in over half of the hashes."""
    n = len(hashes)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65536):  # a long text's bits are counted in parts
        ones += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text."""
    return fold(shingle_hashes(text, shingle))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """One key for each band of the minimum sketch.

    The hashes are mixed and dealt into BANDS * ROWS bins by one multiplication,
    each bin keeps its least, an empty one takes over from the next with a mark
    of the distance, and ROWS bins make a band's key.
    """
    bins = BANDS * ROWS
    if not len(hashes):
        return np.zeros(BANDS, dtype=np.int64)
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    least = np.full(bins, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, ((mixed >> np.uint64(40)) % np.uint64(bins)).astype(np.int64), mixed)
    full = np.flatnonzero(least != np.iinfo(np.uint64).max)
    after = full[np.searchsorted(full, np.arange(bins)) % len(full)]
    gap = (after - np.arange(bins)) % bins
    filled = least[after] + gap.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    key = np.zeros(BANDS, dtype=np.uint64)
    for row in filled.reshape(BANDS, ROWS).T:
        key = (key ^ (key >> np.uint64(29)) ^ row) * np.uint64(0xBF58476D1CE4E5B9)
    return key.view(np.int64)


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, sketched: bool = False) -> tuple[DataFrame, list[str]]:
    """``docs`` with their fingerprint as a signed long and, if asked for, their bands' keys and a hash of their set of shingles; and those columns' names.

    Where bands are asked for, the fingerprint counts each shingle once.
    """
    names = fresh(docs, "fingerprint", "sketch", "shingle_set")[: 3 if sketched else 1]

    def make():
        def run(batch: list[bytes | None]) -> list[pa.Array]:
            prints, keys, sets = [], [], []
            for text in batch:
                hashes = shingle_hashes(text, shingle, folded=sketched)
                if sketched:  # the similarity is one of sets, so repeats must not move the fingerprint
                    hashes = np.unique(hashes)
                    keys.append(sketch(hashes))
                    sets.append(xxhash.xxh3_64_intdigest(hashes.tobytes()))
                prints.append(fold(hashes))
            out = [pa.array(np.array(prints, dtype=np.uint64).view(np.int64))]
            return out + ([pa.array(keys, pa.list_(pa.int64())), pa.array(np.array(sets, dtype=np.uint64).view(np.int64))] if sketched else [])

        return run

    kinds = (T.LongType(), T.ArrayType(T.LongType()), T.LongType())
    return append_columns(docs, text_col, [T.StructField(n, k) for n, k in zip(names, kinds)], make), names


def masks(blocks: int, radius: int) -> list[int]:
    """Bit masks of every choice of ``blocks - radius`` of the blocks."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(x) for x in combinations(parts, blocks - radius)]


class Planes:
    """Vertical bit planes of some fingerprints: word w of plane p holds bit p of 64 of them."""

    def __init__(self, values: np.ndarray, skip: int = 0) -> None:
        n = len(values)
        self.words = -(-n // 64)
        padded = np.zeros(self.words * 64, dtype="<u8")
        padded[:n] = values
        bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        self.order = [p for p in range(64) if not skip >> p & 1]  # bits that all have in common add nothing
        self.planes = [np.packbits(bits[:, p], bitorder="little").view("<u8").copy() for p in self.order]
        self.live = np.full(self.words, ~np.uint64(0), dtype=np.uint64)
        if n % 64:
            self.live[-1] = np.uint64((1 << n % 64) - 1)

    def forget(self, rows: np.ndarray) -> None:
        np.bitwise_and.at(self.live, rows // 64, ~(np.uint64(1) << (rows % 64).astype(np.uint64)))

    def near(self, value: int, radius: int) -> np.ndarray:
        """Rows still live within ``radius`` of ``value``."""
        at = np.flatnonzero(self.live)
        width = radius.bit_length() + 1
        counters = [np.zeros(len(at), dtype=np.uint64) for _ in range(width)]
        over = ~self.live[at]  # lanes that are gone or too far
        for k, (p, plane) in enumerate(zip(self.order, self.planes)):
            carry = plane[at] ^ (~np.uint64(0) if value >> p & 1 else np.uint64(0))
            for i in range(width):  # carry-save: each plane adds one bit to every lane's counter
                counters[i], carry = counters[i] ^ carry, counters[i] & carry
            over |= carry
            if k % 4 == 3 or k == len(self.order) - 1:
                over |= _exceeds(counters, radius)
                keep = over != ~np.uint64(0)
                if not keep.all():  # blocks in which every lane exceeds the radius are abandoned
                    at, over, counters = at[keep], over[keep], [c[keep] for c in counters]
                    if not len(at):
                        return np.zeros(0, dtype=np.int64)
        lanes = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(len(at), 64)
        word, lane = np.nonzero(lanes)
        return at[word] * 64 + lane


def _exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is greater than ``radius``."""
    greater = np.zeros_like(counters[0])
    equal = np.full_like(counters[0], ~np.uint64(0))
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            equal &= counters[i]
        else:
            greater |= equal & counters[i]
            equal &= ~counters[i]
    return greater


def trees(values: np.ndarray, radius: int, shared: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """For each value that reaches others: (its index, those first reached from it), breadth first."""
    if len(values) <= 8:  # too few for a plane
        left = list(range(len(values)))
        while left:
            todo = [left.pop()]
            while todo:
                i = todo.pop()
                got = [j for j in left if int(values[i] ^ values[j]).bit_count() <= radius]
                if got:
                    yield i, np.array(got)
                    left = [j for j in left if j not in got]
                    todo += got
        return
    planes = Planes(values, shared)
    seen = np.zeros(len(values), dtype=bool)
    for seed in range(len(values)):
        if seen[seed]:
            continue
        todo = [seed]
        seen[seed] = True
        planes.forget(np.array([seed]))
        while todo:
            i = todo.pop()
            got = planes.near(int(values[i]), radius)
            if len(got):
                planes.forget(got)
                seen[got] = True
                todo += got.tolist()
                yield i, got


_EDGES = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.LongType(), False)])


def deal_blocks(distinct: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(m, k, f): every fingerprint under the bits of each choice of blocks."""
    signed = [x - (1 << 64) if x >> 63 else x for x in masks(blocks, radius)]
    keys = F.array(*(F.struct(F.lit(i).alias("m"), F.col("f").bitwiseAND(F.lit(x)).alias("k")) for i, x in enumerate(signed)))
    return distinct.select(F.explode(keys).alias("x"), "f").select("x.m", "x.k", "f")


def deal_bands(rows: DataFrame, f: str, keys: str) -> DataFrame:
    """(m, k, f): every fingerprint under the key of each band of its texts' sketches."""
    return rows.select(F.posexplode(col(keys)).alias("m", "k"), col(f).alias("f")).distinct()


def links(dealt: DataFrame, radius: int, common: list[int] | None = None) -> DataFrame:
    """Edges (a, b) between fingerprints that connect whatever shares a key (m, k) and is within ``radius``.

    ``common`` masks, for each ``m``, the bits that all of a bucket share.
    """
    dealt = in_pairs(dealt, ["m", "k"], "f", BUCKET)
    ordered = dealt.repartition("m", "k", "i", "j").sortWithinPartitions("m", "k", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        hand: list[np.ndarray] = []  # the bucket that goes on
        key = None

        def settle(values: np.ndarray, m: int) -> tuple[list, list]:
            a, b = [], []
            for i, got in trees(values, radius, common[m] if common else 0):
                a.append(np.full(len(got), values[i]))
                b.append(values[got])
            return a, b

        def out(a: list, b: list) -> Iterator[list[pa.Array]]:
            if a:
                yield [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)]

        for batch in batches:
            if not batch.num_rows:
                continue
            m, k, f, one, two = (np.asarray(batch.column(i)) for i in range(5))
            f = f.astype(np.int64).view(np.uint64)
            starts = np.r_[0, np.flatnonzero((m[1:] != m[:-1]) | (k[1:] != k[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])) + 1]
            ends = np.r_[starts[1:], len(f)]
            a: list = []
            b: list = []
            # Buckets of one, inside the batch, have nothing to compare.
            busy = np.flatnonzero(ends - starts > 1)
            edge = {0, len(starts) - 1}
            for g in sorted({*busy.tolist(), *edge}):
                s, e = int(starts[g]), int(ends[g])
                own = (int(m[s]), int(k[s]), int(one[s]), int(two[s]))
                if hand and own == key:
                    hand.append(f[s:e])
                else:
                    if hand and len(whole := np.concatenate(hand)) > 1:
                        x, y = settle(whole, key[0])
                        a += x
                        b += y
                    hand, key = [f[s:e]], own
            yield from out(a, b)
        if hand and len(whole := np.concatenate(hand)) > 1:
            yield from out(*settle(whole, key[0]))

    return map_rows(ordered, run, _EDGES).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge list (a, b): root is the least node of its component.

    Alternating large-star and small-star steps; each is a minimum by node, which
    is taken before the shuffle, and a join that adaptive execution can split where
    a node has very many edges. Every round is written to the shared folder.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.where("b < a")
        least = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("n"), F.least("a", "low").alias("low"))
        joined = both.join(least, F.col("a") == F.col("n"))
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(least.select(F.col("n").alias("a"), F.col("low").alias("b")))
        return out.where("a != b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = state(now)
    while seen[0]:
        last, now = now, written(star(star(now, large=True), large=False), "edges")
        discard(last)
        if (after := state(now)) == seen:
            break
        seen = after
    # At rest every edge leads from a node to the least of its component.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _first(id_col: str, tag: str) -> Column:
    """The first row by id (nulls last), then by tag."""
    return F.min(F.struct(col(id_col).isNull().alias("unknown"), col(id_col).alias("id"), col(tag).alias("tag")))


def group(rows: DataFrame, id_col: str, f: str, tag: str, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(f, component, keeper, n) for every distinct fingerprint of ``rows``.

    ``component`` is the least id that can be reached, ``keeper`` the ``tag`` of
    the first row of the component by id (nulls last), then by tag, and ``n`` the
    number of rows with the fingerprint.
    """
    ids = written(rows.groupBy(col(f).alias("f")).agg(_first(id_col, tag).alias("least"), F.count("*").alias("n")), "fingerprints")
    roots = components(links(deal_blocks(ids.select("f"), radius, blocks), radius, masks(blocks, radius)))
    rooted = written(ids.join(roots, F.col("f") == F.col("node"), "left").select("f", F.coalesce("root", "f").alias("root"), "least", "n"), "rooted")
    best = rooted.groupBy("root").agg(F.min("least").alias("best"), F.count("*").alias("members")).select(F.col("root").alias("r"), "best", "members")
    joined = join_skewed(rooted, best, "root", "r", "members", ids.count())
    return written(joined.select("f", F.col("best.id").alias("component"), F.col("best.tag").alias("keeper"), "n"), "groups")


def alike(sets: list[np.ndarray]) -> list[int]:
    """For each set of hashes the least index in its component, where sets with a Jaccard similarity of SIMILAR or more are linked.

    Two such sets share one of their rarest hashes, of which so many are looked
    up that this is certain; what shares one is compared in full.
    """
    over, under = SIMILAR
    root = list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    sizes = [len(x) for x in sets]
    _, which, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(held), dtype=np.int64)
    rank[np.argsort(held, kind="stable")] = np.arange(len(held))
    alone = int((held == 1).sum())  # the ranks below are in one set only
    parts = np.split(rank[which], np.cumsum(sizes)[:-1])
    holders: dict[int, list[int]] = {}
    mark = np.zeros(len(held), dtype=bool)
    for i, own in enumerate(parts):
        n = sizes[i]
        seen: set[int] = set()
        for r in np.sort(own)[: n + over * n // -under + 1].tolist():
            if r >= alone:
                seen.update(at := holders.setdefault(r, []))
                at.append(i)
        mark[own] = True
        for j in sorted(seen):
            a, b = find(i), find(j)
            if a != b and under * min(n, sizes[j]) >= over * max(n, sizes[j]):
                both = int(np.count_nonzero(mark[parts[j]]))
                if under * both >= over * (n + sizes[j] - both):
                    root[max(a, b)] = min(a, b)
        mark[own] = False
    return [find(i) for i in range(len(sets))]


_ROOTS = T.StructType([T.StructField("node", T.LongType(), False), T.StructField("root", T.LongType(), False), T.StructField("cut", T.BooleanType(), False)])


def verified(candidates: DataFrame, shingle: int) -> DataFrame:
    """(node, root, cut) for every text of ``candidates`` that is like another one of its group.

    The columns of ``candidates`` are component, i, j, own (a hash of the set of
    shingles) and text; component, i and j make a group. ``cut``: whether the
    group is but a pair of blocks of its component.
    """
    ordered = candidates.toDF("component", "i", "j", "own", "text").repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        own: list[int] = []  # of the group that goes on
        sets: list[np.ndarray] = []
        now = None

        def settle() -> Iterator[list[pa.Array]]:
            if len(sets) > 1:
                nodes, at = np.array(own, dtype=np.int64), np.array(alike(sets))
                linked = np.flatnonzero(np.bincount(at, minlength=len(at))[at] > 1)
                if len(linked):
                    yield [pa.array(nodes[linked]), pa.array(nodes[at[linked]]), pa.array(np.full(len(linked), now[2] > 0))]
            own.clear()
            sets.clear()

        for whole in batches:
            for batch in small_slices(whole, 4):
                for *key, node, text in zip(*(batch.column(i).to_pylist() for i in range(4)), texts(batch, 4)):
                    if key != now:
                        yield from settle()
                        now = key
                    own.append(node)
                    sets.append(np.unique(shingle_hashes(text, shingle, folded=True)))
        yield from settle()

    return map_rows(ordered, run, _ROOTS)


def similar(rows: DataFrame, id_col: str, text_col: str, shingle: int, radius: int, f: str, keys: str, own: str, tag: str) -> DataFrame:
    """The ``tag`` of the first row of each component of texts with a Jaccard similarity of SIMILAR or more."""
    nodes = written(rows.groupBy(col(f).alias("f"), col(own).alias("own")).agg(_first(id_col, tag).alias("least")), "shingle-sets")
    loose = components(links(deal_bands(rows, f, keys), radius))
    joined = nodes.join(loose, F.col("f") == F.col("node"), "left")
    rooted = written(joined.select(F.coalesce("root", "f").alias("component"), "own", F.col("least.tag").alias("first")), "rooted")
    several = rooted.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select(F.col("component").alias("c"), "n")
    suspects = written(join_skewed(rooted, several, "component", "c", "n", nodes.count()).select("component", "own", "first"), "suspects")
    paired = in_pairs(suspects, ["component"], "own", GROUP)
    texts_of = rows.select(col(tag).alias("t"), col(text_col).alias("x"))
    found = written(verified(texts_of.join(paired.hint("merge"), F.col("t") == F.col("first")).select("component", "i", "j", "own", "x"), shingle), "verified")
    # A pair of blocks has but some of a component's links; what they link is joined once more.
    whole = found.where("not cut").select("node", "root")
    if not (parts := found.where("cut and node != root")).isEmpty():
        whole = whole.unionByName(components(parts.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    joined = nodes.join(whole, F.col("own") == F.col("node"), "left")
    return joined.groupBy(F.coalesce("root", "own")).agg(F.min("least").alias("best")).select(F.col("best.tag").alias(tag))


def marked(docs: DataFrame, text_col: str, shingle: int, keep_text: bool, sketched: bool = False) -> tuple[DataFrame, str, list[str]]:
    """``docs`` with a row tag and the columns of ``fingerprints``, as a table in the shared folder, so that texts are hashed once."""
    out, names = fingerprints(docs, text_col, shingle, sketched)
    (tag,) = fresh(out, "row_tag")
    out = out.withColumn(tag, F.monotonically_increasing_id())
    return written(out if keep_text else out.drop(col(text_col)), "simhash"), tag, names


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = WIDE_SHINGLE, radius: int = WIDE_RADIUS, blocks: int | None = None
) -> DataFrame:
    """One row of each component of near-copies, the first by id (nulls last), with the same columns.

    With ``blocks`` the search is exact for a small ``radius``; without, bands deal
    out candidates, and near-copies are those with a similarity of SIMILAR or more.
    """
    rows, tag, (f, *more) = marked(docs, text_col, shingle, keep_text=True, sketched=blocks is None)
    (k,) = fresh(rows, "keeper")
    if blocks is None:
        keepers = similar(rows, id_col, text_col, shingle, radius, f, *more, tag).select(col(tag).alias(k))
    else:
        keepers = group(rows, id_col, f, tag, radius, blocks).select(F.col("keeper").alias(k)).distinct()
    return rows.join(keepers, col(tag) == col(k), "left_semi").select(*(col(x) for x in docs.columns))


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    rows, tag, (f,) = marked(docs.select("doc_id", "text"), "text", SHINGLE, keep_text=False)
    groups = group(rows, "doc_id", f, tag).select(F.col("f").alias("g"), "component", "n")
    digits = F.lower(F.lpad(F.hex(col(f)), 16, "0"))
    joined = join_skewed(rows, groups, f, "g", "n", rows.count())
    return joined.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))
