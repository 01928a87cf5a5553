"""Near-duplicate documents by SetSketch registers.

A document is its set of word shingles. Each shingle throws a series of points at the registers: the j-th lies in the
j-th of m exponentially spaced intervals (a truncated exponential variable) and hits another register; a register keeps
the smallest point, on a logarithmic scale. Registers of a union are the larger of the two, so sketches are mergeable,
and equal registers are about as likely as the sets are similar. Bands of four registers name buckets. In each bucket
every set is paired with the smallest id (a star, not all pairs); the similarity of a pair is estimated by maximum
likelihood from how many registers are larger, smaller and equal, and confirmed on the full sets. Where a bucket still
holds several components, the pairs between them are estimated and confirmed too, so that no link is lost.

At similarity 0.8, 32 bands of four miss a pair with probability 5e-8. A pair whose estimate lies six standard errors
below the threshold is not confirmed.

Defined cases: null, empty and blank texts have an empty set, are linked with nothing and kept; texts with fewer words
than a shingle are one shingle; texts of any length are taken whole. Equal sets form one class, whatever their number.
Rows with the same id are one document. Rows without an id belong to the component of their equals, and are kept only
if there are none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semstore.llm.common import bytes_of, id_and_text, mix, slices, staged, window_hashes
from semstore.llm.components import components

REGISTERS, BAND = 128, 4
BASE, RATE, TOP = 1.001, 20.0, 65_535
SHINGLE, PERCENT = 5, 80
#: Rows of one bucket that are compared in one task with another such block.
BLOCK = 16_000

_STEP = np.arange(REGISTERS + 1)
with np.errstate(divide="ignore"):
    #: Where the intervals begin: the j-th is from _EDGE[j] to _EDGE[j + 1].
    _EDGE = -np.log((REGISTERS - _STEP) / REGISTERS) / RATE


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    number = _WordHash()
    tokens = [t.lower().split() for t in texts]
    counts = np.array([len(t) for t in tokens])
    first = np.r_[0, np.cumsum(counts)]
    ids = np.fromiter((number[w] for t in tokens for w in t), dtype=np.uint64, count=int(first[-1]))
    hashes = window_hashes(ids, size)
    out = []
    for a, b in zip(first, first[1:], strict=False):
        if b - a >= size:
            out.append(np.unique(hashes[a : b - size + 1]))
        elif b > a:
            out.append(window_hashes(np.r_[np.uint64(b - a), ids[a:b]], b - a + 1))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers (16 bits) of each set; those of an empty set are 0."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate([*sets, np.empty(0, dtype=np.uint64)])
    least = np.full((len(sets), REGISTERS), np.inf)
    mask = np.uint64(REGISTERS - 1)
    for step in range(REGISTERS):
        if not len(elements):
            break
        place = _permuted(elements, step, mask)
        share = (mix(elements ^ np.uint64(step * 0x9E3779B1 + 1)) >> np.uint64(11)) * 2.0**-53
        point = -np.log((REGISTERS - step - share) / REGISTERS) / RATE
        np.minimum.at(least.reshape(-1), owner * REGISTERS + place.astype(np.int64), point)
        # later points lie beyond the next edge: done where every register has a smaller one
        going = (least.max(axis=1) > _EDGE[step + 1])[owner]
        owner, elements = owner[going], elements[going]
    with np.errstate(divide="ignore"):
        levels = np.floor(1 - np.log(least) / math.log(BASE))
    return np.clip(np.where(np.isfinite(least), levels, 0), 0, TOP).astype(np.uint16)


def _permuted(elements: np.ndarray, step: int, mask: np.uint64) -> np.ndarray:
    """The register that an element's point of this step hits: a permutation of the registers for each element."""
    with np.errstate(over="ignore"):
        x = (np.uint64(step) * (elements | np.uint64(1)) + (elements >> np.uint64(7))) & mask
        x ^= x >> np.uint64(3)
        x = (x * ((elements >> np.uint64(14)) | np.uint64(1)) + (elements >> np.uint64(21))) & mask
        x ^= x >> np.uint64(4)
        return (x * ((elements >> np.uint64(28)) | np.uint64(1)) + (elements >> np.uint64(35))) & mask


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sets from their registers (rows) and sizes."""
    larger, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = REGISTERS - larger - smaller
    u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)
    chance = lambda x: -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)

    def likelihood(j):
        p, q = chance(np.maximum(u - v * j, 0)), chance(np.maximum(v - u * j, 0))
        with np.errstate(divide="ignore", invalid="ignore"):
            parts = [np.where(n > 0, n * np.log(x), 0) for n, x in ((larger, p), (smaller, q), (equal, 1 - p - q))]
        return sum(parts)

    low, high = np.zeros(len(a)), np.minimum(u / v, v / u)
    ratio = (math.sqrt(5) - 1) / 2
    for _ in range(40):  # golden section; the likelihood has one peak
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        up = likelihood(left) < likelihood(right)
        low, high = np.where(up, left, low), np.where(up, high, right)
    return (low + high) / 2


def cutoff(percent: int) -> float:
    t = percent / 100
    return t - 6 * math.sqrt(t * (1 - t) / REGISTERS)


def _registers(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.view(np.uint16).reshape(-1, REGISTERS)


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n (size of the set), class (128-bit hash of the set, null if empty) and bands (registers, four to a long)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(bytes_of(part.column("text")), shingle)
                bands = sketch(sets).view(np.int64)
                names = [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(names, pa.string()),
                        pa.array(list(bands), pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n", "class", "bands"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, class string, bands array<long>")


def _sets_of(docs: DataFrame, shingle: int) -> DataFrame:
    """id and shingles, the hashes of each document's set."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(bytes_of(part.column("text")), shingle)
                column = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), column], names=["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles array<long>")


def buckets(classes: DataFrame) -> DataFrame:
    """bucket, id and band for every class in a bucket with others, and the first id there."""
    named = classes.select("id", F.posexplode("bands").alias("band", "value"))
    named = named.select(F.xxhash64("band", "value").alias("bucket"), "id", "band")
    shared = named.groupBy("bucket").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    # written first: Spark can then split the large partitions of a frequent bucket
    shared = staged(shared.where(F.col("first") < F.col("last")).select("bucket", "first"), "shared-buckets")
    return named.join(shared, "bucket")


def star_pairs(members: DataFrame) -> DataFrame:
    return members.where(F.col("id") != F.col("first")).select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()


def promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose estimated similarity may reach the threshold."""
    lowest = cutoff(percent)
    of = lambda side: classes.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("bands").alias(f"r{side}"))
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    joined = pairs.join(of("b"), "b").join(of("a"), "a").where(fits)

    def run(batches):
        for batch in batches:
            a, b = _registers(batch.column("ra")), _registers(batch.column("rb"))
            sizes = [batch.column(c).to_numpy().astype(np.float64) for c in ("na", "nb")]
            found = estimate(a, b, *sizes)
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"])
            yield out.filter(pa.array(found >= lowest))

    return joined.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar enough on their full sets."""
    of = lambda side: sets.select(F.col("id").alias(side), F.col("shingles").alias(f"s{side}"))
    both = pairs.join(of("b"), "b").join(of("a"), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    counted = both.select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).alias("total"))
    return counted.where(F.col("common") * 100 >= (F.col("total") - F.col("common")) * percent).select("a", "b").distinct()


def links_between(members: DataFrame, linked: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components within a bucket, as many as it takes to join them.

    Only rows outside the bucket's largest component are paired with all others, in blocks of a bounded size. A pair
    is looked at in the first band it has in common only. If its estimate is promising, it is tested on short hashes of
    the shingles, unless links found before join its components already.
    """
    known = linked.select(F.col("node").alias("id"), "component")
    placed = members.select("bucket", "id", "band").join(known, "id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.sum("n").alias("rows"),
        F.max("n").alias("most"),
    )
    mixed = mixed.where(F.col("rows") > F.col("most"))
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    mixed = mixed.select("bucket", "main", blocks(F.col("rows")).alias("n_all"), blocks(F.col("rows") - F.col("most")).alias("n_minor"))
    rows = staged(placed.join(mixed, "bucket"), "mixed-buckets")
    deal = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    own = ("bucket", "band", "id", "component")
    every = rows.select(
        *own, F.lit(False).alias("minor"), deal(F.col("n_all")).alias("j"), F.explode(F.sequence(F.lit(0), F.col("n_minor") - 1)).alias("i")
    )
    minor = rows.where(F.col("component") != F.col("main")).select(
        *own, F.lit(True).alias("minor"), F.explode(F.sequence(F.lit(0), F.col("n_all") - 1)).alias("j"), deal(F.col("n_minor")).alias("i")
    )
    short = sets.select("id", F.transform("shingles", lambda x: (x % (1 << 31)).cast("int")).alias("shingles")).dropDuplicates(["id"])
    short = short.join(rows.select("id").distinct(), "id", "left_semi")
    shown = staged(classes.select("id", "n", "bands").join(short, "id"), "compared")
    together = every.unionByName(minor).join(shown, "id").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            keys = np.column_stack([rows.column(c).to_numpy() for c in ("bucket", "i", "j")])
            changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            last = int(changes[-1]) if len(changes) else 0
            if last:  # whole blocks only; the last one may go on
                yield from _compared(rows.slice(0, last), np.r_[0, changes], percent)
            held = rows.slice(last).combine_chunks().to_batches()[0]
        if held is not None:
            yield from _compared(pa.Table.from_batches([held]), np.array([0, held.num_rows]), percent)

    columns = ("bucket", "i", "j", "band", "id", "component", "minor", "n", "bands", "shingles")
    return together.select(*columns).mapInArrow(run, "a long, b long").distinct()


#: Pairs that are compared at once.
PAIRS = 50_000


def _compared(rows: pa.Table, bounds: np.ndarray, percent: int):
    """Links of a minor and another row of one block; bounds are where the blocks begin, and the end."""
    registers = _registers(rows.column("bands").combine_chunks())
    bands = registers.view(np.int64)
    ids, part, band = (rows.column(c).to_numpy() for c in ("id", "component", "band"))
    n, minor = rows.column("n").to_numpy().astype(np.float64), rows.column("minor").to_numpy(zero_copy_only=False)
    sets = rows.column("shingles").combine_chunks()
    flat, cut = sets.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(pa.compute.list_value_length(sets).to_numpy(zero_copy_only=False))]
    block = np.searchsorted(bounds, np.arange(len(ids)), side="right") - 1
    others = np.flatnonzero(~minor)
    first = np.searchsorted(block[others], np.arange(len(bounds)))
    xs = np.flatnonzero(minor)
    counts = first[block[xs] + 1] - first[block[xs]]
    before = np.r_[0, np.cumsum(counts)]
    joined: dict[int, int] = {}

    def top(component: int) -> int:
        while component in joined:
            component = joined[component]
        return component

    at = 0
    while at < len(xs):
        end = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS, side="right")) - 1)
        own, size = xs[at:end], counts[at:end]
        x = np.repeat(own, size)
        y = others[np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size - first[block[own]], size)]
        fits = (part[x] != part[y]) & (np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent)
        x, y = x[fits], y[fits]
        once = (bands[x] == bands[y]).argmax(axis=1) == band[x]
        x, y = x[once], y[once]
        # far from the threshold even for a rough estimate
        close = (registers[x] == registers[y]).mean(axis=1) >= cutoff(percent) - 0.1
        x, y = x[close], y[close]
        share = estimate(registers[x], registers[y], n[x], n[y])
        good = share >= cutoff(percent)
        x, y = x[good], y[good]
        found = []
        edges = np.r_[0, np.flatnonzero(x[1:] != x[:-1]) + 1, len(x)] if len(x) else [0]
        for low, high in zip(edges, edges[1:], strict=False):
            a = int(x[low])
            root = top(int(part[a]))
            bs = [b for b in y[low:high].tolist() if top(int(part[b])) != root]
            for b, common in zip(bs, _common(flat, cut, a, np.array(bs, dtype=np.int64)), strict=True):
                one, two = top(int(part[a])), top(int(part[b]))
                # equal short hashes of different shingles only add to what is common, but for two in one set
                if one == two or (common + 2) * 100 < (n[a] + n[b] - common - 2) * percent:
                    continue
                found.append((ids[a], ids[b]))
                least = common - 1 - n[a] * n[b] / 2**30  # without what short hashes may have added
                if least * 100 >= (n[a] + n[b] - least) * percent:  # certain enough to build upon
                    joined[max(one, two)] = min(one, two)
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs.min(axis=1)), pa.array(pairs.max(axis=1))], names=["a", "b"])
        at = end


def _common(flat: np.ndarray, cut: np.ndarray, a: int, others: np.ndarray) -> list[int]:
    """How many values of each of the other sets are in set `a`."""
    if not len(others):
        return []
    own = np.unique(flat[cut[a] : cut[a + 1]])
    size = cut[others + 1] - cut[others]
    first = np.cumsum(size) - size
    values = flat[np.arange(int(size.sum())) + np.repeat(cut[others] - first, size)]
    inside = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
    return np.add.reduceat(inside.astype(np.int64), first).tolist()


def near_duplicates(
    docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) and kept (the first of each component)."""
    source = id_and_text(docs, id_col, text_col)
    drawn = staged(sketches(source, shingle), "sketches")
    usable = drawn.where(F.col("class").isNotNull())
    classes = usable.groupBy("class").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = staged(classes, "classes")
    single = classes.where(F.col("id").isNotNull()).select("id", "n", "bands")
    members = staged(buckets(single), "buckets")
    # texts are read again once, for the documents that share a bucket with others
    wanted = members.select(F.col("id").alias("doc_id")).distinct()
    sets = staged(_sets_of(source.join(wanted, "doc_id", "left_semi"), shingle), "sets")
    links = staged(confirmed(staged(promising(star_pairs(members), single, percent), "pairs"), sets, percent), "links")
    linked = components(links)
    between = staged(links_between(members, linked, single, sets, percent), "pairs")
    if not between.isEmpty():
        linked = components(links.unionByName(confirmed(between, sets, percent)))
    names = classes.select("class", F.col("id").alias("node")).join(linked, "node", "left")
    names = names.select("class", F.coalesce("component", "node").alias("component"))
    found = drawn.join(names, "class", "left")
    component = F.coalesce("component", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, component.isNull())
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))
