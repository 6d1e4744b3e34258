"""Near-dedup, decontamination, repeated passages and the pipeline, held against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from enrichlab.llm import common, decontaminate, minhash_dedup, passage_dedup
from enrichlab.llm.common import stored
from tests.llm.conftest import EDGES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(words):
    k = min(5, len(words))
    return Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if k else Counter()


def alike(x, y):
    whole = sum((x | y).values())
    return sum((x & y).values()) / whole if whole else 1.0


def brute_classes(texts):
    """{id: least id connected by similarity 0.8} of {id: text}."""
    sets = {i: counted(WORD.findall(t or "")) for i, t in texts.items()}
    holders = {}
    for i, s in sets.items():
        for x in s or [None]:
            holders.setdefault(x, []).append(i)
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    seen = set()
    for group in holders.values():
        for n, i in enumerate(group):
            for j in group[:n]:
                if (i, j) not in seen:
                    seen.add((i, j))
                    if alike(sets[i], sets[j]) >= 0.8:
                        a, b = find(i), find(j)
                        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def family(rng, n, words=200, edits=3):
    """A text and edited copies of it."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(1, edits)):
            copy[rng.randrange(words)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(8)
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    extra = family(rng, 40) + family(rng, 6) * 3 + ["one two", "one two", "one three", "", " "]
    return rows | {10_000 + i: t for i, t in enumerate(extra)}


@pytest.fixture(scope="module")
def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").repartition(6)


def test_signatures_estimate_weighted_similarity():
    rng, off = random.Random(3), []
    for size in (20, 200, 3000):
        for _ in range(12):
            a = [rng.choice("abcdefgh") + str(rng.randrange(size)) for _ in range(size)]
            b = a[: int(size * rng.random())] + [str(rng.random()) for _ in range(size // 4)]
            x, y = (minhash_dedup.signature(minhash_dedup.shingles(w)) for w in (a, b))
            off.append((x == y).mean() - alike(counted(a), counted(b)))
    assert abs(np.mean(off)) < 0.03 and np.max(np.abs(off)) < 0.2


def test_weights_count():
    x = minhash_dedup.shingles("a b c d e a b c d e a b c d e".split())
    assert len(set(minhash_dedup.weighted_regions(x).tolist())) == len(x)


def test_classes_equal_brute_force(frame, texts):
    got = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicate_classes(frame).collect()}
    assert got == brute_classes(texts)


def test_a_chain_is_one_class(spark):
    # each text is similar to its neighbours only
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[6 * i : 6 * i + 150])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicate_classes(df).collect()}
    assert got == brute_classes(dict(rows)) and len(set(got.values())) == 1


def test_pairs_in_a_crowded_key(spark, monkeypatch):
    """Pairs of one large family that meet in few crowded keys, away from its centre; several blocks."""
    rng = random.Random(17)

    def edited(words, n):
        out = list(words)
        for at in rng.sample(range(5, len(words) - 5), n):
            out[at] = f"e{rng.randrange(10**9)}"
        return out

    base = [f"w{i}" for i in range(240)]
    rows = []
    for _ in range(250):
        first = edited(base, 4)
        rows += [" ".join(first), " ".join(edited(first, 5))]
    rng.shuffle(rows)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    sets = [set(counted(r.split())) for r in rows]
    links = [(j, i) for i, x in enumerate(sets) for j in range(i) if (both := len(x & sets[j])) >= 0.8 * (len(x) + len(sets[j]) - both)]
    want = list(range(len(rows)))
    for _ in rows:
        for a, b in links:
            want[a] = want[b] = min(want[a], want[b])
    monkeypatch.setattr(minhash_dedup, "BLOCK", 100)
    got = {r.doc_id: r.class_id for r in minhash_dedup.near_duplicate_classes(df).collect()}
    assert [got[i] for i in range(len(rows))] == want


@pytest.mark.parametrize("cells", [1, 5000, 1 << 24])
def test_a_block_gives_links_between_components_only(monkeypatch, cells):
    import numpy as np

    monkeypatch.setattr(minhash_dedup, "CELLS", cells)
    rng = random.Random(cells)
    base = list(range(40))
    sets = [sorted({*rng.sample(base, rng.randint(34, 40)), 100 + rng.randrange(30)}) for _ in range(70)]
    comp = np.array([rng.choice([1, 1, 1, 2, 3, 10 + i]) for i in range(70)])
    leads = np.array([c != 1 for c in comp])
    order = [i for i in range(70) if leads[i]] + list(range(70))  # leaders come again as members
    found = minhash_dedup.join_links(comp[order], np.array([k < leads.sum() for k in range(len(order))]), [np.array(sets[i], np.uint64) for i in order])
    assert len(found) < len(set(comp.tolist()))

    def similar(a, b):
        both = len(set(sets[a]) & set(sets[b]))
        return both >= 0.8 * (len(sets[a]) + len(sets[b]) - both)

    def closed(links):
        label = {i: int(comp[i]) for i in range(70)}
        for a, b in links:
            old, new = label[a], label[b]
            label = {i: new if v == old else v for i, v in label.items()}
        return {frozenset(i for i in label if label[i] == v) for v in label.values()}

    got = [(order[a], order[b]) for a, b in found]
    assert all(similar(a, b) for a, b in got)
    assert closed(got) == closed([(a, b) for a in range(70) for b in range(a) if similar(a, b)])


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(60), rng.randrange(60, 120)) for _ in range(60)] + [(i, i + 1) for i in range(200, 230)]
    root = {x: x for e in links for x in e}
    for _ in range(200):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.comp for r in minhash_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == root


def test_one_of_each_class_stays(frame, texts):
    kept = minhash_dedup.keep_one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_classes(texts).values()))


def test_dedup_of_edges(edges, nothing):
    rows = minhash_dedup.near_duplicate_classes(edges).collect()
    assert len(rows) == len(EDGES)
    by = {r.doc_id: r.class_id for r in rows}
    assert by[6] == 5 and by[3] == by[7] == 2 and by[1] == 1 and by[8] == 8
    kept = minhash_dedup.keep_one_of_each(edges)
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 5, 8, 9] and kept.columns == edges.columns
    assert minhash_dedup.near_duplicate_classes(nothing).count() == minhash_dedup.keep_one_of_each(nothing).count() == 0


def brute_leaks(texts, items):
    out = {}
    for d, text in texts.items():
        w = WORD.findall(text or "")
        for i, item in items.items():
            v = WORD.findall(item or "")
            if not v or not w:
                continue
            want, k = counted(v), min(5, len(v))
            for p in range(max(1, len(w) - len(v) + 1)):
                part = w[p : p + len(v)]
                have = Counter(tuple(part[x : x + k]) for x in range(len(part) - k + 1))
                s = alike(have, want)
                if s >= 0.8 and s > out.get((d, i), (0,))[0]:
                    out[d, i] = s, p
    return out


def leaking_texts(spark):
    rng = random.Random(6)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    items |= {9000: "just three words", 9001: None, 9002: "", 9003: " ".join(f"x{i}" for i in range(60))}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(30).collect()}
    for n, (_, t) in enumerate(sorted((i, t) for i, t in items.items() if t)):
        w = t.split()
        for e in range(3):  # whole, with words changed, cut at an end
            v = list(w)
            for _ in range(e):
                v[rng.randrange(len(v))] = "changed"
            texts[5000 + 10 * n + e] = " ".join(["before"] * rng.randrange(9) + v + ["after"] * rng.randrange(9))
        texts[5000 + 10 * n + 5] = " ".join(w[: len(w) * 19 // 20])
    return texts, items


def test_leaks_equal_brute_force(spark):
    texts, items = leaking_texts(spark)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    want = brute_leaks(texts, items)
    for block in (decontaminate.BLOCK_SHINGLES, 300):
        found = decontaminate.find_leaks(docs, bench, block_shingles=block).collect()
        assert {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start_word) for r in found} == {k: (round(s, 9), p) for k, (s, p) in want.items()}
        assert all(r.bits <= decontaminate.RADIUS for r in found)
    kept = {r.doc_id for r in decontaminate.drop_leaks(docs, bench, block_shingles=300).collect()}
    assert kept == texts.keys() - {d for d, _ in want}


def test_blocks_guarantee_the_radius():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a = rng.integers(0, 256, 8)
        flips = rng.choice(64, int(rng.integers(0, decontaminate.RADIUS + 1)), replace=False)
        b = a.copy()
        for f in flips:
            b[f // 8] ^= 1 << (f % 8)
        assert any(decontaminate._NEAR[x, y] for x, y in zip(a, b, strict=True))


def test_leaks_of_edges(spark, edges, nothing):
    bench = spark.createDataFrame([(1, "a small text of some ten words is what"), (None, "x"), (2, None), (1, "x")], "item_id long, text string")
    found = decontaminate.find_leaks(edges, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.n_words) for r in found) == [(1, 1, 9), (1, 1, 9), (8, 1, 1)]
    assert decontaminate.find_leaks(nothing, bench).count() == 0
    assert decontaminate.find_leaks(edges, bench.limit(0)).count() == 0
    assert decontaminate.drop_leaks(edges, bench.limit(0)).count() == len(EDGES)


def test_coverable_places_are_those_of_some_stretch():
    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(150):
        match = rng.random(rng.integers(1, 160)) < rng.choice([0.5, 0.85, 0.9, 0.95, 1.0])
        score = np.where(match, 1, -passage_dedup.WORTH)
        want = np.zeros(len(match), bool)
        for i in range(len(match)):
            for j in range(i + passage_dedup.MIN_SHINGLES, len(match) + 1):
                if score[i:j].sum() >= 0:
                    want[i:j] = True
        got = passage_dedup._coverable(match)
        assert got.tolist() == want.tolist()
        for at in range(0, len(match), 7):
            span = passage_dedup._stretch(match, at)
            if span and span[1] - span[0] >= passage_dedup.MIN_SHINGLES:
                assert got[at]


def test_compact_windows_equal_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        n, width = rng.randrange(1, 100), rng.randrange(1, 20)
        g = np.array([rng.randrange(1 << 60) if rng.random() < 0.8 else 5 for _ in range(n)], np.uint64)
        places, first, last = passage_dedup.compact_windows(g, 1, width)
        # every stretch of `width` shingles or more lies in exactly one window
        for i in range(n - width + 1):
            for j in range(i + width - 1, n):
                assert sum(a <= i <= c <= j <= b for c, a, b in zip(places, first, last, strict=True)) == 1
        assert (last - first + 1 >= width).all()


def test_shared_keys_across_batches(spark):
    rng = random.Random(12)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 2, 3, 7, 1000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
            rows = [(rng.randrange(12), rng.choice([1, 1, 1, 2, 3]) * (1 + key % 3), i, 0) for i, key in enumerate([rng.randrange(12) for _ in range(60)])]
            docs = {}
            for key, doc, *_ in rows:
                docs.setdefault(key, set()).add(doc)
            df = spark.createDataFrame(rows, "key long, doc long, place int, reach int")
            assert sorted(map(tuple, passage_dedup._shared(df).collect())) == sorted(r for r in rows if len(docs[r[0]]) > 1)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def shared_windows(texts, size=50):
    seen = {}
    for d, t in texts.items():
        w = WORD.findall(t or "")
        for i in range(len(w) - size + 1):
            seen.setdefault(tuple(w[i : i + size]), set()).add(d)
    return {k: v for k, v in seen.items() if len(v) > 1}


def uncovered(texts, rows):
    spans = {}
    for r in rows:
        spans.setdefault(r.doc_id, []).append((r.start_word, r.start_word + r.n_words))
    shared, out = shared_windows(texts), set()
    for d, t in texts.items():
        w = WORD.findall(t or "")
        for i in range(len(w) - 49):
            if tuple(w[i : i + 50]) in shared and not any(a <= i and i + 50 <= b for a, b in spans.get(d, [])):
                out.add((d, i))
    return out


def check_rows(texts, rows):
    """Every row holds: long enough, similar by an exact count, the representative's passage there."""
    words = {d: WORD.findall(t or "") for d, t in texts.items()}
    for r in rows:
        a = words[r.doc_id][r.start_word : r.start_word + r.n_words]
        b = words[r.rep_id][r.rep_start_word : r.rep_start_word + r.rep_n_words]
        assert len(a) == r.n_words >= 50 <= len(b) == r.rep_n_words and r.rep_id <= r.doc_id
        assert alike(counted(a), counted(b)) == pytest.approx(r.similarity)


def test_passages_equal_brute_force(frame, texts):
    rows = passage_dedup.repeated_passages(frame).collect()
    assert not uncovered(texts, rows)
    check_rows(texts, rows)
    assert len(rows) == len(set(rows))


def test_passages_behind_a_common_line(spark):
    """Many texts share a short line; some of them also a passage, with or without edits."""
    rng = random.Random(9)
    line = " ".join(f"common{i}" for i in range(14))
    long_line = " ".join(f"longer{i}" for i in range(45))

    def words(n):
        return " ".join(f"u{rng.randrange(10**7)}" for _ in range(n))

    passage, texts = words(45), {}
    for i in range(120):
        kind = i % 4
        own = f"{line}\n{passage}" if kind == 1 else f"{long_line}\n{words(9)}" if kind == 2 else f"{line}\n{words(40)}"
        texts[i] = f"{words(30 + i % 50)} {own} {words(40)}"
    texts[500] = words(90)
    changed = texts[500].split()
    changed[45] = "changed"
    texts[501] = " ".join(changed)
    texts[502] = " ".join(changed[:30] + ["put", "in"] + changed[30:])
    rows = passage_dedup.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert not uncovered(texts, rows)
    check_rows(texts, rows)
    assert {r.doc_id for r in rows} == {i for i in range(120) if i % 4 == 1} | {500, 501, 502}


def test_edited_passages_behind_strangers(spark):
    """Pairs with an edited passage, and texts of smaller ids that hold the shingles of all its minima between random
    words, some of them with words around: at least nine in ten are found."""
    import numpy as np

    rng = random.Random(12)

    def words(n):
        return [f"u{rng.randrange(10**7)}" for _ in range(n)]

    texts, pairs, stranger = {}, [], 0
    for k in range(60):
        passage = words((64, 110)[k % 2])  # similarity 0.846 and 0.828
        changed = list(passage)
        for at in rng.sample(range(3, len(passage) - 3), 1 + k % 2):
            changed[at] = "changed"
        a, b = 1000 + 2 * k, 1001 + 2 * k
        texts[a], texts[b] = " ".join(words(20) + passage + words(30)), " ".join(words(35) + changed + words(10))
        pairs.append((a, b))
        own = texts[a].split()
        places = set()
        for j in range(passage_dedup.HASHES):
            places |= set(passage_dedup.compact_windows(passage_dedup.hashed(texts[a]), j)[0].tolist())
        around = (0, 0, 3)[k % 3]  # a stranger may share a longer phrase
        out = []
        for at in sorted(places):
            out += words(6) + own[max(0, at - around) : at + 5 + around]
        texts[stranger] = " ".join(out + words(60))
        stranger += 1
    rows = passage_dedup.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)).collect()
    check_rows(texts, rows)
    found = {(r.rep_id, r.doc_id) for r in rows}
    assert np.mean([p in found for p in pairs]) >= 0.9
    assert not any(r.doc_id < 1000 for r in rows)


def test_verbatim_passages_across_leaders(spark):
    """Repeats whose places lie inside another document's passage, or behind a partial copy in the least
    document."""
    rng, texts = random.Random(21), {}

    def words(n):
        return " ".join(f"u{rng.randrange(10**7)}" for _ in range(n))

    for at in range(0, 150, 10):
        w, v = words(60).split(), words(50).split()
        texts[at] = f"{words(60)} {' '.join(w[:58])} {words(60)}"
        texts[at + 1] = f"{words(60)} {' '.join(w)} {words(60)}"
        texts[at + 2] = f"{words(60)} {' '.join(w[10:])} {words(60)}"
        texts[at + 3] = f"{words(60)} {' '.join(v[1:48])} {words(400)} {' '.join(v)} {words(60)}"
        texts[at + 4] = f"{words(60)} {' '.join(v)} {words(60)}"
    rows = passage_dedup.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert not uncovered(texts, rows)
    check_rows(texts, rows)
    assert {r.doc_id for r in rows} == set(texts)


def test_stretches_meet_the_first_of_their_key_across_batches(spark):
    rng = random.Random(13)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 2, 3, 7, 1000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
            rows = [(f"d{rng.randrange(4)}", rng.randrange(12), i) for i in range(60)]
            least = {}
            for doc, key, place in rows:
                least[key] = min(least.get(key, (doc, place)), (doc, place))
            want = sorted((least[key][0], doc, place, least[key][1], 0) for doc, key, place in rows if doc != least[key][0])
            df = spark.createDataFrame(rows, "doc string, key long, place int")
            assert sorted(map(tuple, passage_dedup._stretch_star(df).collect())) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_passages_in_blocks_leave_no_shuffle_files_and_few_tables(spark, frame, monkeypatch, tmp_path):
    want = sorted(map(tuple, passage_dedup.repeated_passages(frame).collect()))
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: sum(f.getName().startswith("shuffle_") for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(files.getAllFiles()))
    monkeypatch.setattr(passage_dedup, "PAIRS", 20)
    monkeypatch.setattr(common, "work_dir", lambda session: str(tmp_path))
    before, cleanup = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    out = passage_dedup.repeated_passages(frame)
    assert shuffled() <= before
    left = {p.name.split("-")[0] for p in tmp_path.iterdir()}
    assert "rows" in left and not left & {"prints", "copies", "met", "exact", "pairs", "left", "second"}
    assert sorted(map(tuple, out.collect())) == want
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == cleanup


def test_passages_of_edges(edges, nothing):
    rows = passage_dedup.repeated_passages(edges).collect()
    assert {r.doc_id for r in rows} == {5, 6} and {r.rep_id for r in rows} == {5}
    assert passage_dedup.repeated_passages(nothing).count() == 0


def test_pipeline_equals_brute_force(spark):
    from enrichlab.llm.bpe import default_ranks, load_ranks
    from enrichlab.llm.quality_rules import measure_quality
    from enrichlab.llm.secret_scan import find_secrets, redact
    import hashlib

    import public_tokenizers
    import tiktoken

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in measure_quality(docs).filter("kept").collect()}
    texts = {d: t for d, t in texts.items() if d in good}
    texts = {d: texts[d] for d in set(brute_classes(texts).values())}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    leaked = {d for d, _ in brute_leaks(texts, items)}
    with open(default_ranks(), "rb") as f:
        enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(f.read()), special_tokens={})
    want = {}
    for d, t in texts.items():
        if d not in leaked:
            clean = redact(t, find_secrets(t))
            ids = enc.encode_ordinary(clean)
            want[d] = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(clean.encode()).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_keep_columns_on_edges(spark, edges, nothing):
    for frame in (edges, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stored(stage(spark, frame, SF), name)
            assert out.columns == frame.columns
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF).count() == frame.count()


def test_links_of_a_family_grow_with_its_members(spark):
    """Members that meet the same hubs at every band keep a link each; the components stay."""
    hubs, members = range(10), range(100, 400)
    links = [(h, m) for m in members for h in hubs if (m + h) % 10 or m % 7] + [(900, 901), (901, 902), (900, 902)]
    few = minhash_dedup._fewer(spark.createDataFrame(links, "leader long, node long").repartition(5))
    assert few.count() <= len(members) + len(hubs) ** 2 + 3 < len(links) / 5
    comp = {r.node: r.comp for r in minhash_dedup.components(few).collect()}
    assert comp == {**{n: 0 for n in (*hubs, *members)}, 900: 900, 901: 900, 902: 900}
    apart = minhash_dedup._apart(spark.createDataFrame([(0, 399), (0, 900), (5, 777)], "leader long, node long"), minhash_dedup.components(few))
    assert {tuple(r) for r in apart.collect()} == {(0, 900), (5, 777)}
