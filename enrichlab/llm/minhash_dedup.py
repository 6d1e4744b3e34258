"""Near-duplicate documents by DartMinHash signatures and banded joining.

**Signatures.**  A document is a weighted set: its shingles of five words, weighted by how often they
occur.  Every unit of weight of a shingle is a region into which a hashed Poisson process throws
darts; a dart has a rank (its arrival time), and a coordinate of the signature.  Only darts up to a
rank limit are thrown, about ``k ln k + 4k`` for the whole document and not ``k`` per shingle; the
limit doubles until each of the ``k = BANDS * ROWS`` coordinates has a dart.  The earliest dart of a
coordinate is the same in two documents with probability equal to their weighted Jaccard similarity.

**Joining.**  Equal word sequences are one node from the start (their group is aggregated before
anything else), so copies are never paired.  Nodes that share a band meet at that band's key.  A key
of up to ``SMALL_KEY`` nodes compares them all.  In a crowded key, where all pairs would grow with the
square of a family, each member is compared with the hub, the member that shares most bands with
others (the centre of a family of edited copies), and, if that left them apart, with its neighbour in the order of a further band
and the size (texts with the same edit or cut).  Keys that then still hold several components are settled in one
pass: every member outside the largest one meets all members of other components, in blocks of bounded rows and
bytes.  A block holds the texts' regions, so it compares exactly, keeps its own components, and hands on only the
links that join two of them: fewer than its rows, whatever the size of a family.  So two texts that share a band are
in one class exactly if links connect them.

All intermediate tables lie in the shared folder; links and components stay distributed.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from enrichlab.llm.common import bounded_side, mix64, shingle_hashes, stored, text_slices, texts_of, word_hashes

BANDS, ROWS = 25, 6
K = BANDS * ROWS
SHINGLE = 5
SIMILARITY = 0.8
#: Share of equal one-byte sketches below which a pair cannot be similar (0.8 less over 6 deviations).
SKETCH_SHARE = 0.56
#: Nodes up to which a key compares all of them.
SMALL_KEY = 8
#: Members of a key in one block and bytes of their regions, and cells of a comparison at a time.
BLOCK, BLOCK_BYTES, CELLS = 1024, 16 << 20, 16 << 20
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(words: list[str]) -> np.ndarray:
    """Hashes of a text's shingles; a text of one to four words is one shingle."""
    h = word_hashes(words)
    return shingle_hashes(h, min(SHINGLE, len(words))) if len(words) else np.empty(0, np.uint64)


def weighted_regions(hashes: np.ndarray) -> np.ndarray:
    """One region per unit of weight: the m-th occurrence of a shingle, as a hash."""
    ordered = np.sort(hashes)
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    start = np.maximum.accumulate(np.where(first, np.arange(len(ordered)), 0))
    m = (np.arange(len(ordered)) - start).astype(np.uint64)
    return mix64(ordered + m * np.uint64(0xD6E8FEB86659FD93))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def _darts(regions: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Ranks and hashes of all darts up to ``limit``: the arrivals of one Poisson process per region.

    The first arrivals of all regions are drawn as one matrix; the few regions that need more go on
    one arrival at a time.
    """
    ahead = math.ceil(limit + 4 * math.sqrt(limit) + 3) if limit > 1.5 else 1
    ranks, darts = [], []
    live, rank = regions, np.zeros(len(regions))
    s = 0
    while len(live):
        step = np.arange(s + 1, s + ahead + 1, dtype=np.uint64) * _STEP
        dart = mix64(live[:, None] + step)
        gaps = np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
        rank = rank[:, None] - np.cumsum(gaps, axis=1)
        near = rank <= limit
        ranks.append(rank[near])
        darts.append(dart[near])
        live, rank = live[near[:, -1]], rank[near[:, -1], -1]
        s, ahead = s + ahead, 1
    return np.concatenate(ranks), np.concatenate(darts)


def signature(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The hash of the earliest dart of each of ``k`` coordinates."""
    regions = weighted_regions(hashes)
    limit = (k * math.log(k) + 4 * k) / len(regions)
    while True:
        rank, dart = _darts(regions, limit)
        at = ((mix64(dart) >> np.uint64(32)) % np.uint64(k)).astype(np.int64)
        order = np.argsort(-rank)
        best = np.full(k, -1, np.int64)
        best[at[order]] = order  # the earliest is written last
        if (best >= 0).all():
            return dart[best]
        limit *= 2  # a coordinate got no dart: throw further


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One key per band, different for different bands."""
    rows = mix64(sig.reshape(BANDS, ROWS))
    key = np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(40)
    for i in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key.view(np.int64)


def similarity(a: str, b: str) -> float:
    """Exact weighted Jaccard similarity of two texts' shingles; 1 for two texts without words."""
    x, y = WORD.findall(a), WORD.findall(b)
    if x == y:
        return 1.0
    return counted_similarity(_counted(x), _counted(y))


def _counted(words: list[str]) -> Counter:
    k = min(SHINGLE, len(words))
    return Counter(zip(*(words[i:] for i in range(k)), strict=False)) if k else Counter()


def counted_similarity(x: Counter, y: Counter) -> float:
    if len(x) > len(y):
        x, y = y, x
    both = sum(min(n, y[s]) for s, n in x.items() if s in y)
    whole = sum(x.values()) + sum(y.values()) - both
    return both / whole if whole else 1.0


def _sign(docs: DataFrame) -> DataFrame:
    """(id, fp, n, bands, sketch): bands is null for a text without words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, 1):
            fp, sizes, bands, sketch = [], [], [], []
            for text in texts_of(piece, 1):
                words = WORD.findall(text)
                fp.append(xxhash.xxh3_128_digest(" ".join(words)))
                h = shingles(words)
                sizes.append(len(h))
                sig = signature(h) if len(h) else None
                bands.append(None if sig is None else band_keys(sig))
                sketch.append(None if sig is None else (mix64(sig) & np.uint64(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(fp, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.binary())], ["id", "fp", "n", "bands", "sketch"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, fp binary, n long, bands array<long>, sketch binary")


def _alike(pairs: DataFrame) -> DataFrame:
    """Pairs whose sketches agree often enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(-1, K) for i in (2, 3))
                yield pa.RecordBatch.from_arrays([c.filter(pa.array((x == y).mean(axis=1) >= SKETCH_SHARE)) for c in b.columns[:2]], ["leader", "node"])

    kind = pairs.schema["leader"].dataType.simpleString()
    return pairs.select("leader", "node", "sketch_a", "sketch_b").mapInArrow(run, f"leader {kind}, node {kind}")


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (leader, node) that are similar, exactly."""
    # a leader may have very many members: its text is joined last, and that side can be split
    frame = pairs.join(texts.select(F.col("node"), F.col("text").alias("b")), "node").join(texts.select(F.col("node").alias("leader"), F.col("text").alias("a")), "leader").select("leader", "node", "a", "b")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, counted = None, Counter()
        for piece in text_slices(batches, 3):
            ok = []
            for leader, a, b in zip(piece.column(0).to_pylist(), texts_of(piece, 2), texts_of(piece, 3), strict=True):
                if last != leader:
                    last, counted = leader, _counted(WORD.findall(a))
                ok.append(counted_similarity(counted, _counted(WORD.findall(b))) >= SIMILARITY)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in piece.columns[:2]], ["leader", "node"])

    kind = pairs.schema["leader"].dataType.simpleString()
    return frame.mapInArrow(run, f"leader {kind}, node {kind}")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (two columns): the least node that it is connected with.

    Labels go to neighbours and then to the label's label, until nothing changes; each round is a
    table in the shared folder.  Sums over a hub's neighbours are combined in each task first.
    """
    edges = links.toDF("a", "b")
    both = stored(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        pulled = labels.join(near, labels["node"] == near["a"]).select("node", F.least("comp", "near").alias("comp"), F.col("comp").alias("was"))
        jump = labels.select(F.col("node").alias("j"), F.col("comp").alias("further"))
        new = stored(pulled.join(jump, F.col("comp") == F.col("j"), "left").select("node", F.least("comp", F.coalesce("further", "comp")).alias("comp"), "was"), "labels")
        changed = new.filter("comp <> was").limit(1).count()
        labels = new.select("node", "comp")
        if not changed:
            return labels


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``class_id`` (the least id among all documents connected
    by similarity 0.8 or more) and ``copy_of`` (the least id with the same words).

    Documents without words, null texts included, are copies of each other.  Rows of one id are one
    document.  Rows with a null id belong to no class: their class_id is their copies' class if
    those have ids, else null.
    """
    frame = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = stored(_sign(frame), "signatures")
    # copies first: one node per word sequence, combined in each task
    nodes = stored(signed.groupBy("fp").agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")).filter("node is not null"), "nodes")
    met = nodes.filter("bands is not null").select("node", F.posexplode("bands").alias("band", "key"))
    shared = met.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    met = stored(met.join(shared, "key"), "met")
    # per node: how many it meets in all, and its crowded keys (at most one per band)
    places = F.collect_list(F.when(F.col("members") > SMALL_KEY, F.struct("key", "band"))).alias("places")
    info = stored(nodes.select("node", "n", "bands", "sketch").join(met.groupBy("node").agg(F.sum("members").alias("hub"), places), "node"), "crowd")
    texts = stored(frame.join(bounded_side(info.select(F.col("node").alias("id")).distinct()), "id").groupBy("id").agg(F.first("text").alias("text")).withColumnRenamed("id", "node"), "texts")
    small = met.filter(F.col("members") <= SMALL_KEY).select("key", "node")
    beside = F.element_at("bands", (F.col("band") + 1) % BANDS + 1).alias("next")
    crowded = info.select("node", "hub", "n", "bands", F.inline("places")).select("key", "node", "hub", "n", beside)
    crowded = stored(crowded, "crowded")
    # first pass: all pairs of a small key; in a crowded key each member with the hub, then with a neighbour
    hubs = crowded.groupBy("key").agg(F.max(F.struct("hub", "node")).alias("h")).select("key", F.col("h.node").alias("leader"))
    pairs = _unordered(small.withColumnRenamed("node", "leader").join(small, "key").select("leader", "node"))
    pairs = pairs.union(crowded.join(hubs, "key").filter("leader <> node").select("leader", "node").distinct())
    links = stored(_fewer(_verify(_alike(_similar_size(pairs, info)), texts)), "links")
    comps = components(links)
    # a neighbour that the hubs have linked already adds nothing
    nearby = stored(_verify(_alike(_similar_size(_apart(_unordered(_neighbours(crowded)), comps), info)), texts), "links")
    if nearby.limit(1).count():
        links = links.union(nearby)
        comps = components(links)
    # last pass: members of different components in one key, until each two are linked or compared
    more = stored(_block_links(info, comps, texts), "links")
    if more.limit(1).count():
        comps = components(links.union(more))
    copies = nodes.select("fp", F.col("node").alias("copy_of"))
    out = signed.select("id", "fp").join(copies, "fp", "left")
    out = out.join(comps.withColumnRenamed("node", "copy_of"), "copy_of", "left").withColumn("class_id", F.coalesce("comp", "copy_of"))
    return out.select(F.col("id").alias(id_col), "class_id", "copy_of")


def _unordered(pairs: DataFrame) -> DataFrame:
    """Each pair of different nodes once."""
    return pairs.filter("leader <> node").select(F.least("leader", "node").alias("leader"), F.greatest("leader", "node").alias("node")).distinct()


def _fewer(links: DataFrame) -> DataFrame:
    """The same components by fewer links: each node with the least of its leaders, and its leaders one after the other.  The members of
    a family have the same few hubs, so a member keeps one link, however many keys it shares with them."""
    held = links.groupBy("node").agg(F.array_sort(F.collect_set("leader")).alias("leaders"))  # at most a few per band
    pair = lambda i: F.struct(F.element_at("leaders", i).alias("leader"), F.element_at("leaders", i + 1).alias("node"))
    rows = held.filter(F.size("leaders") > 1).select(F.inline(F.transform(F.sequence(F.lit(1), F.size("leaders") - 1), pair)))
    return held.select(F.element_at("leaders", 1).alias("leader"), "node").union(rows.distinct())


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs that no links connect yet."""
    a = comps.select(F.col("node").alias("leader"), F.col("comp").alias("comp_a"))
    b = comps.select("node", F.col("comp").alias("comp_b"))
    j = pairs.join(b, "node", "left").join(a, "leader", "left")
    return j.filter(F.coalesce("comp_a", "leader") != F.coalesce("comp_b", "node")).select("leader", "node")


def _neighbours(crowded: DataFrame) -> DataFrame:
    """(leader, node): members of a key next to each other by a further band and then by size.  Dealt
    out by ranges, so a crowded key is split over tasks; two members that fall on either side of a cut are
    not paired here."""
    rows = crowded.select("key", "next", "n", "node").repartitionByRange("key", "next", "n", "node").sortWithinPartitions("key", "next", "n", "node")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.Table.from_batches([batch] if before is None else [before, batch]).combine_chunks().to_batches()[0]
            key = whole.column(0).to_numpy(zero_copy_only=False)
            same = pa.array(key[1:] == key[:-1])
            nodes = whole.column(3)
            yield pa.RecordBatch.from_arrays([nodes.slice(0, len(nodes) - 1).filter(same), nodes.slice(1).filter(same)], ["leader", "node"])
            before = whole.slice(whole.num_rows - 1)

    kind = crowded.schema["node"].dataType.simpleString()
    return rows.mapInArrow(run, f"leader {kind}, node {kind}")


def _regions(texts: DataFrame) -> DataFrame:
    """(node, regions, n): the sorted region hashes of each text as one binary value."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in text_slices(batches, 1):
            made = [np.sort(weighted_regions(shingles(WORD.findall(t)))) for t in texts_of(piece, 1)]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([m.tobytes() for m in made], pa.binary()), pa.array([len(m) for m in made], pa.int64())], ["node", "regions", "n"])

    kind = texts.schema["node"].dataType.simpleString()
    return texts.select("node", "text").mapInArrow(run, f"node {kind}, regions binary, n long")


def join_links(comp: np.ndarray, leads: np.ndarray, regions: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of rows that are similar and join two components, in a block: row i leads if ``leads[i]``; leaders meet all
    other rows of components that are different when their turn comes."""
    x, y = np.flatnonzero(leads), np.flatnonzero(~leads)
    if not len(x) or not len(y):
        return []
    sizes = np.array([len(r) for r in regions])
    known, codes = np.unique(np.concatenate(regions), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    label = pd.factorize(comp)[0]
    met = np.concatenate([codes[starts[j] : starts[j + 1]] for j in y])
    first = np.concatenate([[0], np.cumsum(sizes[y])[:-1]])
    out = []
    step = max(1, min(256, CELLS // max(len(met), len(known))))
    for a in range(0, len(x), step):
        part = x[a : a + step]
        held = np.zeros((len(part), len(known)), np.uint8)
        for k, i in enumerate(part):
            held[k, codes[starts[i] : starts[i + 1]]] = 1
        both = np.add.reduceat(held[:, met], first, axis=1, dtype=np.int32)
        alike = both / (sizes[part][:, None] + sizes[y] - both) >= SIMILARITY
        for k, i in enumerate(part):
            near = y[alike[k]]
            apart, at = np.unique(label[near], return_index=True)
            for other, j in zip(apart.tolist(), near[at].tolist(), strict=True):
                if other != label[i]:
                    out.append((int(i), int(j)))
                    label[label == other] = label[i]
    return out


def _block_links(info: DataFrame, comps: DataFrame, texts: DataFrame) -> DataFrame:
    """(leader, node): links between different components of the members of a crowded key (``info``: node, n, places), enough to
    connect all that are similar.

    Of two components one is not the largest of the key, so only members outside that one lead.  A key's leaders and
    members go to blocks by hash, as many as its rows and bytes ask for, and each leader meets each member in one
    block.
    """
    labelled = info.filter(F.size("places") > 0).select("node", "n", F.col("places.key").alias("keys")).join(comps, "node", "left")
    labelled = stored(labelled.withColumn("comp", F.coalesce("comp", "node")), "labelled")
    # keys that hold several components; all others are settled
    apart = labelled.select("comp", F.explode("keys").alias("key")).groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    placed = stored(labelled.select("node", "n", "comp", F.explode("keys").alias("key")).join(apart, "key", "left_semi"), "open")
    by_comp = placed.groupBy("key", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("size"))
    sizes = by_comp.groupBy("key").agg(F.sum("c").alias("m"), F.sum("size").alias("m_size"), F.max(F.struct("c", "comp", "size")).alias("big"))
    several = sizes.select("key", "m", "m_size", F.col("big.comp").alias("largest"), (F.col("m") - F.col("big.c")).alias("l"), (F.col("m_size") - F.col("big.size")).alias("l_size")).filter("l > 0")
    placed = placed.drop("n").join(several, "key")
    regions = _regions(texts.join(placed.select("node").distinct(), "node", "left_semi"))
    l_blocks, m_blocks = (F.ceil(F.greatest(F.col(c) / BLOCK, F.col(f"{c}_size") * 8 / BLOCK_BYTES)).cast("int") for c in ("l", "m"))
    own = [F.pmod(F.xxhash64("node", F.lit(salt)), blocks).cast("int") for salt, blocks in ((1, l_blocks), (2, m_blocks))]
    leaders = placed.filter("comp <> largest").select("key", own[0].alias("lb"), F.explode(F.sequence(F.lit(0), m_blocks - 1)).alias("mb"), F.lit(True).alias("leads"), "node", "comp")
    others = placed.select("key", F.explode(F.sequence(F.lit(0), l_blocks - 1)).alias("lb"), own[1].alias("mb"), F.lit(False).alias("leads"), "node", "comp")
    rows = leaders.union(others).join(regions.drop("n"), "node").repartition("key", "lb", "mb").sortWithinPartitions("key", "lb", "mb", "leads", "node")

    def linked(block: pa.Table) -> pa.RecordBatch:
        block = block.combine_chunks()
        found = join_links(block.column("comp").to_numpy(), block.column("leads").to_numpy(), [np.frombuffer(r, np.uint64) for r in block.column("regions").to_pylist()])
        node = block.column("node").combine_chunks()
        i, j = (pa.array([p[k] for p in found], pa.int64()) for k in (0, 1))
        return pa.RecordBatch.from_arrays([node.take(i), node.take(j)], ["leader", "node"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of the open block
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "lb", "mb")], axis=1)
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and at != tuple(ids[a]):
                    yield linked(pa.Table.from_batches(held))
                    held = []
                at = tuple(ids[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield linked(pa.Table.from_batches(held))

    kind = info.schema["node"].dataType.simpleString()
    return rows.mapInArrow(run, f"leader {kind}, node {kind}").distinct()


def _similar_size(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """``pairs`` with both sketches, without those whose sizes rule the similarity out."""
    b = info.select("node", F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    a = info.select(F.col("node").alias("leader"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    return pairs.join(b, "node").join(a, "leader").filter(F.least("n_a", "n_b") >= SIMILARITY * F.greatest("n_a", "n_b"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class, the one with the least id, with all columns of ``docs``; rows
    with a null id stay.  Of several rows with one id, one stays."""
    classes = near_duplicate_classes(docs, id_col, text_col).filter(F.col(id_col).isNotNull())
    seen = stored(classes.groupBy(id_col).agg(F.min("class_id").alias("least"), F.count("*").alias("rows")), "kept-ids").filter(F.col(id_col) == F.col("least"))
    # the ids are broadcast if they are few enough, and the texts stay where they are
    once, more = (bounded_side(seen.filter(f"rows {op} 1").select(id_col)) for op in ("=", ">"))
    stay = docs.filter(F.col(id_col).isNull()).unionByName(docs.join(once, id_col, "left_semi"))
    repeated = docs.join(more, id_col, "left_semi").dropDuplicates([id_col])
    return stay.unionByName(repeated).select(docs.columns)
