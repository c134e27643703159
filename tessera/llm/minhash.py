"""Near-duplicate classes by BagMinHash signatures, banding and verified multiset overlap.

A text is the multiset of its runs of five words (a shorter text with words is one
run).  BagMinHash: a run x of weight w (how often it occurs) owns the part [0, w) of
a weight axis that is cut into the intervals [0,1), [1,2), [2,4), [4,8), ...; on each
interval lives a Poisson process of points, fixed by x and the interval alone, whose
rate is the interval's length; every point falls on one signature component and at
one place of the interval, and counts if the place is below w.  A component's value
is its earliest point, so two texts agree in it with the probability of their weighted
Jaccard similarity.  Points are made only up to a time by which all components have one.

Texts of the same words are one node.  Bands of the signature make buckets; each
member of a bucket is compared with one hub (the smallest node), which is linear in
the bucket however large; verified links form components.  In buckets that then hold
several components, the members outside the largest are compared with a second hub,
another one in each bucket.  What still is apart meets all other members by longer
signatures, in blocks within a task, and exactly where these agree as those of similar
texts do.  So two texts of similarity 0.8 that share no bucket (15 pairs in a million), or share one but no hub and have unusual
signatures (one pair in 90,000), may stay apart; all other links are found, however large a bucket is.

Nulls and texts without words are alone in their class; a null doc_id takes no part
and keeps a null class.  Repeated rows, also of one doc_id, are members like others.
Columns other than doc_id and text are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import saved, tidy
from tessera.llm.words import Words, mix, powers, shingles, slices, split, within

WIDTH, LEAST = 5, 0.8
#: A pair of similarity 0.8 misses all bands with a probability of 0.000015.
BANDS, ROWS = 28, 5
SIZE = BANDS * ROWS
#: Of members that no hub links: the size of blocks; the components of their sketches, a byte each; and in how many of the
#: first 128 and of all components texts of similarity 0.8 agree, but for one pair in 90,000 (4.25 standard deviations).
BLOCK, SKETCH, FIRST, AGREE_FIRST, AGREE = 2048, 512, 128, 83, 371
_UNIT = float(1 << 36)
_SECOND = 0xC2B2AE3D27D4EB4F | 1


def text_shingles(words: Words, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The runs of each text: hashes and text numbers, text by text."""
    h, n = words.hashes(), np.diff(words.offsets)
    ok = within(words.offsets, width)
    long_runs, long_at = shingles(h, width)[ok], words.text_of()[: len(ok)][ok]
    short = np.flatnonzero((n > 0) & (n < width))
    if not len(short):
        return long_runs, long_at
    short_runs = np.array([np.bitwise_xor.reduce(mix(h[words.offsets[t] : words.offsets[t + 1]] + np.arange(1, n[t] + 1, dtype=np.uint64) * np.uint64(_SECOND))) for t in short], dtype=np.uint64)
    runs, at = np.concatenate([long_runs, short_runs]), np.concatenate([long_at, short])
    order = np.argsort(at, kind="stable")
    return runs[order], at[order]


def fingerprints(words: Words) -> np.ndarray:
    """128 bits of each text's word sequence."""
    h, out = words.hashes(), np.zeros((len(words.offsets) - 1, 2), dtype=np.uint64)
    place = np.arange(len(h)) - np.repeat(words.offsets[:-1], np.diff(words.offsets))
    for k, base in enumerate((0x9E3779B97F4A7C15 | 1, _SECOND)):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + np.uint64(k)) * powers(base, int(place.max(initial=0)) + 1)[place], dtype=np.uint64)])
        out[:, k] = mix(total[words.offsets[1:]] - total[words.offsets[:-1]] + np.diff(words.offsets).astype(np.uint64))
    return out


def bag_signatures(runs: np.ndarray, at: np.ndarray, n: int, size: int = SIZE) -> np.ndarray:
    """The BagMinHash signature of each of n texts (rows of 0 where a text has no run)."""
    best = np.full(n * size, np.iinfo(np.int64).max, dtype=np.int64)
    if not len(runs):
        return np.zeros((n, size), dtype=np.int64)
    order = np.lexsort((runs, at))
    runs, at = runs[order], at[order]
    first = np.flatnonzero(np.concatenate([[True], (runs[1:] != runs[:-1]) | (at[1:] != at[:-1])]))
    count = np.diff(np.append(first, len(runs)))
    runs, at = runs[first], at[first]
    total = np.bincount(at, weights=count, minlength=n)
    # the intervals that each weight reaches into
    reach = np.ceil(np.log2(count)).astype(np.int64) + 1
    who = np.repeat(np.arange(len(runs)), reach)
    level = np.arange(len(who)) - np.repeat(np.cumsum(reach) - reach, reach)
    length = np.where(level == 0, 1.0, np.exp2(np.maximum(level - 1, 0)))
    floor = np.where(level == 0, 0.0, length)
    seed = mix(runs[who] + (level + 1).astype(np.uint64) * np.uint64(_SECOND))
    text, weight = at[who], count[who].astype(float)
    todo = np.flatnonzero(total > 0)
    reach_time = 6.0
    while len(todo):
        limit = np.zeros(n, np.int64)
        limit[todo] = (size * reach_time / total[todo] * _UNIT).astype(np.int64)
        expected = size * reach_time / np.maximum(total, 1)
        block = np.exp2(np.ceil(np.log2(np.clip(expected, 1, 512)))).astype(np.int64)
        want = np.zeros(n, dtype=bool)
        want[todo] = True
        for b in np.unique(block[todo]).tolist():
            live = np.flatnonzero(want[text] & (block[text] == b))
            now, done = np.zeros(len(live), np.int64), 0
            step = max(1, (1 << 18) // b)
            while len(live):
                stay = []
                for lo in range(0, len(live), step):
                    part = live[lo : lo + step]
                    u = mix(seed[part][:, None] + np.arange(done + 1, done + b + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    gap = (-np.log((u >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54) / length[part][:, None] * _UNIT).astype(np.int64)
                    t = now[lo : lo + step][:, None] + np.cumsum(gap, axis=1)
                    v = mix(u + np.uint64(_SECOND))
                    place = floor[part][:, None] + length[part][:, None] * ((v >> np.uint64(32)).astype(float) * 2.0**-32)
                    ok = (t <= limit[text[part]][:, None]) & (place < weight[part][:, None])
                    cell = text[part][:, None] * size + (v & np.uint64(0xFFFFFFFF)).astype(np.int64) % size
                    np.minimum.at(best, cell[ok], t[ok])
                    now[lo : lo + step] = t[:, -1]
                    stay.append(t[:, -1] <= limit[text[part]])
                stay = np.concatenate(stay)
                live, now, done = live[stay], now[stay], done + b
        todo = todo[(best.reshape(n, size)[todo] == np.iinfo(np.int64).max).any(axis=1)]
        reach_time *= 2.2
    out = best.reshape(n, size)
    out[total == 0] = 0
    return out


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    keys = np.zeros((len(signatures), signatures.shape[1] // rows), dtype=np.uint64)
    for j in range(rows):
        keys = mix(keys * np.uint64(_SECOND) + signatures[:, j::rows][:, : keys.shape[1]].view(np.uint64))
    return keys.view(np.int64)


def sign(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, node (128 bits of the words; null without words), and the band keys."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                words = split(batch.column(1).slice(lo, hi - lo))
                runs, at = text_shingles(words)
                nodes = fingerprints(words)
                # equal texts of a slice are signed once
                _, one, back = np.unique(nodes, axis=0, return_index=True, return_inverse=True)
                new = np.full(hi - lo, -1)
                new[one] = np.arange(len(one))
                keep = new[at] >= 0
                signatures = bag_signatures(runs[keep], new[at[keep]], len(one))
                keys = band_keys(signatures)[back.ravel()]
                empty = np.diff(words.offsets) == 0
                node = pa.array([None if e else x.tobytes() for e, x in zip(empty, nodes, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), node, pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32()), pa.array(keys.ravel()))], names=["doc_id", "text_hash", "node", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("text_hash")).mapInArrow(tidy(task), "doc_id long, text_hash long, node binary, bands array<long>")


def similarities(left: pa.Array, right: pa.Array, width: int = WIDTH) -> np.ndarray:
    """The weighted Jaccard similarity of the runs of left[i] and right[i]."""
    n, sides = len(left), []
    for column in (left, right):
        runs, at = text_shingles(split(column), width)
        key, one, count = np.unique(mix(runs + mix(at.astype(np.uint64) + np.uint64(1))), return_index=True, return_counts=True)
        sides.append((key, at[one], count, np.bincount(at, minlength=n)))
    _, x, y = np.intersect1d(sides[0][0], sides[1][0], assume_unique=True, return_indices=True)
    both = np.bincount(sides[0][1][x], weights=np.minimum(sides[0][2][x], sides[1][2][y]), minlength=n)
    return both / np.maximum(sides[0][3] + sides[1][3] - both, 1)


def payloads(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and text for nodes (node, doc_id): the text of that doc_id that has the node's words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                same = [a == b.tobytes() for a, b in zip(part.column(0).to_pylist(), fingerprints(split(part.column(1))), strict=True)]
                yield part.filter(pa.array(same, pa.bool_()))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    return nodes.join(texts, "doc_id").select("node", "text").mapInArrow(tidy(task), "node binary, text string")


def verified(pairs: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs (a, b) whose texts have the similarity or more."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(2), 1 << 20):
                part = batch.slice(lo, hi - lo)
                ok = similarities(part.column(2), part.column(3)) >= least
                yield part.filter(pa.array(ok)).select([0, 1])

    left = pairs.join(texts.withColumnRenamed("node", "b").withColumnRenamed("text", "text_b"), "b")
    both = left.join(texts.withColumnRenamed("node", "a").withColumnRenamed("text", "text_a"), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(tidy(task), "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """node, label of every node of the edges (a, b): label is the smallest node of its component."""
    both = saved(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a")).distinct(), "edges")
    labels = saved(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("label")).withColumnRenamed("u", "node"), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        hooked = saved(labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "hooked")
        jumped = hooked.join(hooked.select(F.col("node").alias("label"), F.col("label").alias("next")), "label").select("node", "old", F.least("label", "next").alias("label"))
        labels = saved(jumped, "labels")
        if labels.where("label <> old").limit(1).count() == 0:
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def sketches(texts: DataFrame) -> DataFrame:
    """node and a byte of each component of a longer signature."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1), 1 << 20):
                runs, at = text_shingles(split(batch.column(1).slice(lo, hi - lo)))
                made = mix(bag_signatures(runs, at, hi - lo, SKETCH).view(np.uint64).ravel()) >> np.uint64(56)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([x.tobytes() for x in made.astype(np.uint8).reshape(hi - lo, -1)], pa.binary())], names=["node", "sketch"])

    return texts.select("node", "text").mapInArrow(tidy(task), "node binary, sketch binary").dropDuplicates(["node"])


def divided(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold several components: band, key, node, hub, label, and of the bucket its largest component, its members and how many are outside that."""
    marked = saved(buckets.where("n > 2").select("band", "key", "node", "hub").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "marked")
    sizes = marked.groupBy("band", "key", "label").agg(F.count("*").alias("m"))
    largest = F.max_by(F.struct("label", "m"), F.struct("m", "label"))
    mixed = sizes.groupBy("band", "key").agg(largest.alias("x"), F.sum("m").alias("members"), F.count("*").alias("labels")).where("labels > 1")
    mixed = saved(mixed.select("band", "key", F.col("x.label").alias("largest"), "members", (F.col("members") - F.col("x.m")).alias("outside")), "mixed")
    return saved(marked.join(mixed, ["band", "key"]), "divided")


def likely_pairs(inside: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of a bucket with different labels whose sketches agree as those of similar texts do.

    inside: band, key, node, label, sketch, bands, largest (label), members, outside (the number of those without it).  The members
    outside the largest component meet all members, in blocks of at most about BLOCK of either side; pairs are made within a task
    and only likely ones leave it, from the first bucket alone that the two share.
    """
    outside, members = (F.greatest(F.lit(1), F.ceil(F.col(c) / BLOCK)).cast("int") for c in ("outside", "members"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    mine = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    columns = ["band", "key", "i", "j", "side", "node", "label", "sketch", "bands"]
    left = inside.where("label <> largest").withColumn("i", mine(outside)).withColumn("j", upto(members)).withColumn("side", F.lit(0)).select(*columns)
    right = inside.withColumn("j", mine(members)).withColumn("i", upto(outside)).withColumn("side", F.when(F.col("label") == F.col("largest"), 1).otherwise(2)).select(*columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            keys = [table.column(k).to_numpy() for k in range(4)]
            cuts = np.concatenate([[0], np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1, [table.num_rows]]) if table.num_rows else np.array([0])
            for lo, hi in zip(cuts[:-2], cuts[1:-1], strict=True):
                yield from block(table.slice(lo, hi - lo))
            held = table.slice(cuts[-2], cuts[-1] - cuts[-2]) if table.num_rows else table
        if held is not None and held.num_rows:
            yield from block(held)

    def block(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        side = rows.column(4).to_numpy()
        if side[0] or not side[-1]:
            return
        nodes, labels = (np.array(rows.column(k).to_pylist(), dtype=object) for k in (5, 6))
        sketches = np.frombuffer(b"".join(rows.column(7).to_pylist()), dtype=np.uint8).reshape(len(side), -1)
        bands, band = np.stack(rows.column(8).to_numpy()), rows.column(0)[0].as_py()
        n, a, b = int((side == 0).sum()), [], []
        for lo in range(0, n, 64):
            agree = (sketches[lo : min(lo + 64, n), None, :FIRST] == sketches[None, n:, :FIRST]).sum(axis=2)
            xs, ys = np.nonzero(agree >= AGREE_FIRST)
            apart = labels[lo + xs] != labels[n + ys]
            xs, ys = lo + xs[apart], n + ys[apart]
            for k in range(0, len(xs), 8192):
                x, y = xs[k : k + 8192], ys[k : k + 8192]
                near = ((sketches[x] == sketches[y]).sum(axis=1) >= AGREE) & ((bands[x] == bands[y]).argmax(axis=1) == band)
                near &= (side[y] == 1) | (nodes[x] < nodes[y])
                for i, j in zip(x[near], y[near], strict=True):
                    a.append(min(nodes[i], nodes[j]))
                    b.append(max(nodes[i], nodes[j]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    dealt = left.union(right).repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j", "side")
    return dealt.mapInArrow(tidy(task), "a binary, b binary").distinct()


def classes(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, text_hash, class_id (smallest doc_id of the class), class_size, for every row of docs (doc_id, text); and label, which no two classes share.

    Two classes have one class_id only where rows with one doc_id have unlike texts.
    """
    signed = saved(sign(docs), "signed")
    nodes = saved(signed.where("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), F.first("bands").alias("bands")), "nodes")
    rows = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    hubs = saved(rows.groupBy("band", "key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1"), "hubs")
    buckets = saved(rows.join(hubs, ["band", "key"]), "buckets")
    pairs = saved(buckets.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    used = buckets.select("node").distinct()
    texts = saved(payloads(docs, nodes.select("node", "doc_id").join(used, "node")), "texts")
    edges = saved(verified(pairs, texts, least), "links")
    labels = saved(components(edges), "components")
    # a bucket that holds several components: those outside its largest meet another hub of it, another one in each bucket
    inside = divided(buckets, labels)
    second = saved(inside.where("label = largest").groupBy("band", "key").agg(F.min_by("node", F.xxhash64("node", "band", "key")).alias("hub2")), "second-hubs")
    again = inside.where("label <> largest").join(second, ["band", "key"]).select(F.least("node", "hub2").alias("a"), F.greatest("node", "hub2").alias("b")).distinct()
    tested = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    again = saved(again.join(tested, ["a", "b"], "left_anti"), "second-pairs")
    linked = saved(verified(again, texts, least), "second-links")
    if linked.limit(1).count():
        edges = saved(edges.union(linked), "all-links")
        labels = saved(components(edges), "components")
    # what then still is apart is compared with all other members
    inside = divided(buckets, labels).where("node <> hub")
    sketched = saved(sketches(texts.join(inside.select("node").distinct(), "node", "left_semi")), "sketches")
    inside = saved(inside.join(sketched, "node").join(nodes.select("node", "bands"), "node"), "inside")
    rest = saved(likely_pairs(inside).join(tested.union(again), ["a", "b"], "left_anti"), "rest")
    more = saved(verified(rest, texts, least), "more-links")
    if more.limit(1).count():
        labels = saved(components(edges.union(more)), "components")
    of_class = saved(labels.join(nodes.select("node", "doc_id", "n"), "node"), "members").groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("n").alias("class_size"))
    by_node = saved(labels.join(saved(of_class, "classes"), "label").select("node", "label", "class_id", "class_size"), "linked")
    by_node = saved(nodes.select("node", "doc_id", "n").join(by_node, "node", "left").select("node", F.coalesce("label", "node").alias("label"), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("class_size", "n").alias("class_size")), "classes")
    alone = F.col("node").isNull() | F.col("doc_id").isNull()
    placed = signed.where(~alone).select("doc_id", "text_hash", "node").join(by_node, "node").select("doc_id", "text_hash", "class_id", "class_size", "label")
    lone = F.concat_ws(" ", "doc_id", "text_hash").cast("binary")
    return placed.union(signed.where(alone).select("doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), lone.alias("label")))


def representatives(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of docs of which one stays for each class: that of its smallest doc_id, and of the smallest text hash where rows of the class share that.

    Rows with a null doc_id stay; of rows equal in doc_id and text one does.  All columns stay, whatever they are called.
    """
    placed = classes(docs, least).where("doc_id IS NOT NULL")
    own_id, own_hash = "own_id", "own_hash"
    while {own_id.lower(), own_hash.lower()} & {c.lower() for c in docs.columns}:
        own_id, own_hash = own_id + "_", own_hash + "_"
    first = placed.groupBy("label").agg(F.min(F.struct(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash))).alias("first"))
    keep = saved(first.select("first.*").distinct(), "kept")
    named = docs.withColumn(own_id, F.col("doc_id").cast("long")).withColumn(own_hash, F.xxhash64(F.col("text").cast("string")))
    stay = named.where(F.col(own_id).isNotNull()).join(keep, [own_id, own_hash], "left_semi").dropDuplicates([own_id, own_hash])
    return stay.unionByName(named.where(F.col(own_id).isNull())).drop(own_id, own_hash)
