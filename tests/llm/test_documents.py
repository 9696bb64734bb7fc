"""Operators on documents against plain versions, on edge cases and on the smallest table."""

from collections import Counter

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tenura.llm import bloom, decontaminate, exact_dedup, line_dedup, packing, queries, simhash, token_grammar, toxicity, words
from tenura.session import new_folder


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_groups_on_edges(edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert bag(exact_dedup.exact_groups(edge), *EXACT) == Counter(plain.exact(rows))
    assert exact_dedup.exact_groups(empty).count() == 0


def test_exact_groups_when_the_filter_is_full(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_FILTER_BYTES", 1 << 14)
    df = spark.range(40_000).select(F.col("id").alias("doc_id"), (F.col("id") % 30_000).cast("string").alias("text"))
    out = exact_dedup.exact_groups(df)
    assert out.where("kept").count() == 30_000 and out.count() == 40_000
    assert out.where("group_size = 2 and keep_id = doc_id + if(doc_id < 10000, 30000, 0)").count() == 20_000


def test_one_of_each_text_stays(edge):
    kept = exact_dedup.keep_one(edge.withColumn("kept", F.lit(7)), exact_dedup.exact_groups(edge))
    assert kept.columns == [*edge.columns, "kept"]
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r.text or "" for r in edge.collect()})


def test_hot_text_is_one_group(spark):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    out = exact_dedup.exact_groups(df)
    assert out.where("group_size = 10000 and keep_id = 29997").count() == 10_000


def test_fingerprints_and_groups_on_edges(edge, empty):
    rows = edge.collect()
    prints = [plain.fingerprint(r.text) for r in rows]
    want = plain.components([r.doc_id for r in rows], plain.near(prints))
    got = simhash.near_groups(edge).select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("f"), "component_id")
    assert Counter(map(tuple, got.collect())) == Counter((r.doc_id, f"{p:016x}", c) for r, p, c in zip(rows, prints, want))
    assert simhash.near_groups(empty).count() == 0


@pytest.mark.parametrize("leaf", [40, 100_000])
def test_links_over_leaves_make_chains(spark, monkeypatch, leaf):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64) * np.uint64(2)
    values = []
    for k, c in enumerate(centres):
        for _ in range(12 if k else 200):  # one large family, and chains of single steps
            for b in rng.integers(0, 64, rng.integers(0, 3)):
                c = c ^ (np.uint64(1) << np.uint64(b))
            values.append(c)
    values = np.array(values, np.uint64)
    ids = list(range(len(values)))
    df = spark.createDataFrame([(i, int(v)) for i, v in zip(ids, values.view(np.int64))], "id bigint, fp bigint")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: df)
    got = {r.doc_id: r.component_id for r in simhash.near_groups(df, leaf=leaf).collect()}
    assert got == dict(zip(ids, plain.components(ids, plain.near(values))))


def test_turned_values_keep_distances():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 2**64, 200, dtype=np.uint64)
    for route in (1, 3, 4, 5, 9, 13, 17, 44):
        read = simhash.turned(values, route, 3)
        equal, parts = simhash.blocks_of(route, 3)
        order = equal + [x for p in parts for x in p]
        assert sorted(order) == list(range(64)) and len(np.unique(read)) == 200
        plainly = [sum((int(v) >> (63 - b) & 1) << (63 - i) for i, b in enumerate(order)) for v in values[:20]]
        assert read[:20].tolist() == plainly
        assert (np.bitwise_count(read ^ read[0]) == np.bitwise_count(values ^ values[0])).all()


@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_each_value_goes_to_a_leaf_of_each_block(spark, budget):
    """Spread values: one leaf a block. Many with one beginning: dealt again. Every near pair shares a leaf."""
    rng = np.random.default_rng(6)
    spread = rng.integers(0, 2**64, 1500, dtype=np.uint64)
    even = spark.createDataFrame([(int(v),) for v in spread.view(np.int64)], "fp bigint")
    assert simhash.leaves_of(even, budget, 200).count() == 1500 * (budget + 1)
    close = (np.uint64(0xABCDEF12345) << np.uint64(20)) | rng.integers(0, 2**20, 900, dtype=np.uint64)
    values = np.unique(np.concatenate([spread, close, spread[:50] ^ np.uint64(1 << 33), close[:50] ^ np.uint64(5)]))
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint")
    leaves = {}
    for r in simhash.leaves_of(df, budget, 60).collect():
        leaves.setdefault((r.route, r.bits, r.node), set()).add(r.fp & (2**64 - 1))
    together = {(a, b) for held in leaves.values() for a in held for b in held if a < b and (a ^ b).bit_count() <= budget}
    small = [int(v) for v in values]
    assert together == {(a, b) for i, a in enumerate(small) for b in small[i + 1 :] if (a ^ b).bit_count() <= budget}


def test_trie_join_finds_every_pair_once():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)) | (np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64))
    a = np.unique(np.concatenate([base, base ^ flips]))
    b = np.unique(base ^ np.uint64(1 << 40))
    pairs = [(int(x), int(y)) for i, j in simhash.near_pairs(a) for x, y in zip(i, j)]
    assert sorted(pairs) == sorted(plain.near(a))
    across = [(int(x), int(y)) for i, j in simhash.near_pairs(a, b) for x, y in zip(i, j)]
    assert sorted(across) == [(i, int(j)) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(b ^ a[i]) <= 2)]


def test_near_copies_leave_one(edge):
    kept = simhash.keep_one(edge, simhash.near_groups(edge))
    assert kept.columns == edge.columns
    groups = {r.doc_id: r.component_id for r in simhash.near_groups(edge).collect() if r.doc_id is not None}
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == {i for i, c in groups.items() if i == c}


@pytest.mark.parametrize("uses", [4, 30])
def test_grammar_goes_on_until_no_pair_is_left(uses):
    rng = np.random.default_rng(5)
    single = rng.permutation(100_000)[:50_000]
    pairs = np.array([[200_000 + k, 300_000 + k] for k in range(10)] * uses)
    ids = np.concatenate([np.concatenate([single[40 * i : 40 * i + 40], p]) for i, p in enumerate(rng.permutation(pairs))] + [np.full(99, 7), single[40 * len(pairs) :]]).astype(np.uint32)
    blob = token_grammar.compress(ids)
    assert (token_grammar.decompress(blob) == ids).all()
    left, most, last = token_grammar._read(blob)[3].tolist(), Counter(), {}
    for at, pair in enumerate(zip(left, left[1:])):
        if last.get(pair, -2) != at - 1:
            most[pair] += 1
            last[pair] = at
    assert most.most_common(1)[0][1] < token_grammar.LEAST_USES


def test_a_text_without_near_copy_stays_where_its_id_is_repeated(spark):
    words = "one two three four five six seven eight"
    rows = [(3, words), (5, words.upper()), (5, "quite another text of its own"), (9, "quite another  text of its own"), (7, None), (8, ""), (8, "clean"), (None, words)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = simhash.keep_one(docs, simhash.near_groups(docs)).collect()
    assert {tuple(r) for r in kept} == {rows[0], rows[2], rows[4], rows[6], rows[7]} and len(kept) == 5


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "hello World"), (3, None), (4, "!!"), (5, "X"),
         (12, "one two three four five six seven eight nine ten eleven twelve thirteen"), (None, "same line")]


def test_decontamination_on_edges(spark, edge, empty):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    clash = edge.withColumn("items", F.lit("mine")).withColumn("n_hit", F.lit(-1))
    got = decontaminate.find_items(clash, items).select("doc_id", "n_words", "n_hit", F.concat_ws(",", "items"), "items_sha256", "contaminated")
    want = []
    import hashlib

    for r in edge.collect():
        n, hit, found, bad = plain.contaminated(r.text, ITEMS)
        want.append((r.doc_id, n, hit, ",".join(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bad))
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert decontaminate.find_items(empty, items).count() == 0
    none = decontaminate.find_items(edge, items.limit(0))
    assert none.where("n_hit = 0 and not contaminated").count() == edge.count()
    kept = decontaminate.clean(clash, items)
    assert kept.columns == clash.columns and kept.where("items <> 'mine' or n_hit <> -1").count() == 0
    assert kept.count() == sum(not w[-1] for w in want)


def test_items_in_parts_give_the_same(spark, edge, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    columns = ["doc_id", "n_words", "n_hit", "items_sha256", "contaminated"]
    whole = bag(decontaminate.find_items(edge, items), *columns)
    monkeypatch.setattr(decontaminate, "PART_BYTES", 40)
    assert bag(decontaminate.find_items(edge, items), *columns) == whole


def test_op6_equals_plain(spark, sf, pair_ids):
    import pyarrow.parquet as pq

    t = pq.read_table(f"{sf}/benchmark.parquet").to_pydict()
    items = list(zip(t["item_id"], t["text"]))
    got = {r.doc_id: r for r in queries.op6_decontaminate(spark, sf).collect()}
    for i, text in pair_ids[:60]:
        n, hit, found, bad = plain.contaminated(text, items)
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].contaminated) == (n, hit, len(found), bad)


def test_op7_equals_plain(spark, sf, pair_ids):
    prints = [plain.fingerprint(t) for _, t in pair_ids]
    want = plain.components([i for i, _ in pair_ids], plain.near(prints))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7_simhash(spark, sf).collect()}
    assert got == {i: (f"{p:016x}", c) for (i, _), p, c in zip(pair_ids, prints, want)}


def test_tokens_round_trip(spark, edge, empty, tmp_path):
    path = queries.vocabulary()
    folder = str(tmp_path / "tokens")
    token_grammar.write_tokens(edge, folder, path, end_id=1)
    got = token_grammar.read_documents(spark, folder, with_ids=True).orderBy("start").collect()
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert [r.doc_id for r in got] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i))
    want = Counter((i, tuple(ids)) for (i, _), ids in zip(rows, plain.tokens([t for _, t in rows], path, 1)))
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    stream = [x for r in got for x in r.ids]
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert all(r.ids_crc32 == plain.crc(r.ids) for r in got)
    for a, b in ((0, 5), (3, 3), (10, 5000), (len(stream) - 3, len(stream) + 9)):
        assert token_grammar.read_ids(spark, folder, a, b) == stream[a:b]
    assert token_grammar.token_table(empty, path).count() == 0


def test_only_odd_words_take_the_long_way(monkeypatch):
    """Ids as the tokenizer gives them, words forgotten between batches too; plain words are encoded as they stand, each once a batch."""
    import pyarrow as pa

    code = words.WordCoder(queries.vocabulary())
    long_way, own = [], code._ids
    monkeypatch.setattr(code, "_ids", lambda w: long_way.append(w) or own(w))
    monkeypatch.setattr(words, "KEPT_WORDS", 4)
    batches = [["one two three one", None, "don't é ÉCOLE 12"], ["two four", "", "one five é"], [""], ["a.b one Two x1 ... don't"]]
    for texts in batches:
        flat, cuts = code.encode(pa.array(texts, pa.string()))
        assert [flat[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [code.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert {"don't", "é", "École".lower(), "12"} <= {w.lower() for w in long_way}
    assert not [w for w in long_way if w.isascii() and w.isalpha()]


@pytest.mark.parametrize("kind", ["none", "one", "same", "few", "many"])
def test_grammar_round_trip(kind):
    rng = np.random.default_rng(2)
    ids = {"none": np.zeros(0), "one": np.array([7]), "same": np.full(999, 3), "few": rng.integers(0, 4, 5000), "many": rng.zipf(1.4, 30_000) % 49_408}[kind].astype(np.uint32)
    blob = token_grammar.compress(ids)
    assert (token_grammar.decompress(blob) == ids).all()
    if kind in ("same", "few"):
        assert len(blob) < 2 * len(ids)
    for a, b in rng.integers(0, len(ids) + 1, (30, 2)):
        assert (token_grammar.decode_range(blob, int(a), int(b)) == ids[a:b]).all()


def test_a_task_sorts_few_texts(spark, empty):
    parts = [token_grammar._parts(n) for n in (0, 1, 510_000_000, 30_000_000_000, 300_000_000_000)]
    assert parts == [1, 1, 31, 1789, 8941]
    text = " ".join(f"w{i % 997}" for i in range(50_000))
    docs = spark.range(300, numPartitions=2).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    folder = new_folder(spark, "tokens")
    token_grammar.write_tokens(docs, folder, queries.vocabulary())
    size = spark.read.parquet(folder).groupBy("part").agg(F.sum(F.size("doc_ids")).alias("n")).agg(F.max("n")).first()[0]
    assert size * len(text) < 32 << 20
    got = token_grammar.read_documents(spark, folder)
    assert got.count() == 300 and got.select("n_tokens", "ids_crc32").distinct().count() == 1


def test_op5_equals_plain(spark, sf, pair_ids):
    got = {r.doc_id: r for r in queries.op5_token_grammar(spark, sf).collect()}
    start = 0
    for (i, _), ids in zip(pair_ids, plain.tokens([t for _, t in pair_ids], queries.vocabulary(), 1)):
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), plain.crc(ids))
        start += len(ids)


def held_together(rows, capacity):
    """Sequences are gapless and fit."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_op8_places_every_piece(spark, sf, pair_ids):
    rows = queries.op8_packing(spark, sf).collect()
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows}
    total = 0
    for (i, _), ids in zip(pair_ids, plain.tokens([t for _, t in pair_ids], queries.vocabulary(), 0)):
        for piece, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at : at + 2048]
            assert got.pop((i, piece)) == (at, len(cut), plain.crc(cut))
        total += len(ids)
    assert not got
    assert held_together(rows, 2048) <= 1 + 1.02 * total / 2048


def test_packed_ids_come_back(spark, edge, empty):
    packed = packing.pack_documents(edge, queries.vocabulary(), capacity=64, with_ids=True)
    rows = packed.collect()
    held_together(rows, 64)
    ids = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in rows:
        assert bytes(ids[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)]) == bytes(r.ids)
    assert packing.pack_documents(empty, queries.vocabulary()).count() == 0


@pytest.mark.parametrize("lengths", [[], [2048] * 3, [1], [1025] * 5, [700] * 100, list(range(1, 2049)), [1500, 548] * 40])
def test_lengths_fit(lengths):
    sequence, offset = packing.pack_lengths(np.array(lengths, np.int64))
    for s in set(sequence.tolist()):
        own = sorted((offset[i], lengths[i]) for i in np.flatnonzero(sequence == s))
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist() and sum(n for _, n in own) <= 2048
    if lengths == [1500, 548] * 40:
        assert len(set(sequence.tolist())) == 40
    if lengths == [700] * 100:
        assert len(set(sequence.tolist())) == 50


def test_lines_on_edges(edge, empty):
    got = line_dedup.drop_boilerplate(edge.withColumn("n_lines", F.lit(-1)), ratio=0.1, least=2)
    rows = [(r.doc_id, r.source, r.text) for r in edge.collect()]
    assert bag(got, "doc_id", "text", "n_lines", "n_dropped") == Counter(plain.lines(rows, 0.1, 2))
    assert got.where("n_dropped > 0").count() > 0
    assert line_dedup.drop_boilerplate(empty).count() == 0


def test_word_hashes_do_not_depend_on_place():
    import pyarrow as pa

    word = "Wörter" + "x" * 70_000
    texts = [f"{'y ' * 40_000}{word} z", f"{word.lower()}", None, "", "a-b a"]
    words, heads, offsets = toxicity.hashed_words(pa.array(texts))
    first, second = words[offsets[0] : offsets[1]], words[offsets[1] : offsets[2]]
    assert second[0] == first[-2] and len(second) == 1
    assert offsets[2] == offsets[3] == offsets[4] and offsets[5] - offsets[4] == 3
    own = words[offsets[4] : offsets[5]]
    assert own[0] == own[2] != own[1]
    assert len(set(heads[offsets[0] : offsets[1]].tolist())) == 3


def toy(n, seed):
    """Texts of random words, a tenth with a word of the wanted kind in two languages."""
    rng = np.random.default_rng(seed)
    texts, label = [], []
    for i in range(n):
        bad = i % 8 == 0
        words = [f"w{k}" for k in rng.integers(0, 3000, rng.integers(5, 120))]
        words += ["the", "of"] * 3 if i % 2 else ["der", "und"] * 3
        if bad:
            words.insert(int(rng.integers(0, len(words))), ["awful", "blöd", "vile"][rng.integers(0, 3)])
        texts.append(" ".join(words))
        label.append(float(bad))
    return texts, np.array(label)


def test_classifier_on_texts_it_has_not_seen():
    import pyarrow as pa

    texts, label = toy(1500, 1)
    net = toxicity.train(pa.array(texts), label)
    texts, label = toy(800, 2)
    said = toxicity.score_texts(net, pa.array(texts)) >= 0.5
    assert said[label == 1].mean() > 0.95 and said[label == 0].mean() < 0.05
    assert toxicity.languages(*[x for k, x in enumerate(toxicity.hashed_words(pa.array(["the of and", "der und", "zz"]))) if k != 1]).tolist() == [0, 1, 4]


def test_scores_do_not_depend_on_company():
    import pyarrow as pa

    texts, label = toy(300, 3)
    net = toxicity.train(pa.array(texts), label)
    texts[5] = texts[5] + " x" * 300_000
    together = toxicity.score_texts(net, pa.array(texts))
    assert np.allclose(together, [toxicity.score_texts(net, pa.array([t]))[0] for t in texts])


def test_op10(spark, sf, edge, empty):
    import zlib

    rows = queries.op10_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 0), (None, 1), (7, None), (8, 5)], "doc_id bigint, toxic int")
    net = toxicity.fit(edge, labels)
    clash = edge.withColumn("score", F.lit("mine"))
    assert toxicity.score(edge, net).count() == edge.count()
    assert toxicity.clean(clash, net).columns == clash.columns
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0


@pytest.mark.parametrize("long_ranks", [[0], [0, 1, 2, 3, 4, 5, 6, 7], [3, 20, 21]])
def test_a_long_text_costs_only_itself(spark, monkeypatch, long_ranks):
    monkeypatch.setattr(toxicity, "TRAIN_DOCS", 6)
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 1000)
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, label: seen.append((texts.to_pylist(), label.tolist())))
    ids = spark.range(60).where(~toxicity.held_out(F.col("id"))).orderBy(F.xxhash64("id"))
    order = [r.id for r in ids.collect()]
    texts = {i: f"{i} " + "x" * (1001 if rank in long_ranks else 40) for rank, i in enumerate(order)}
    docs = spark.createDataFrame([*texts.items(), (order[1], "z" * 2000), (order[1], None)], "doc_id bigint, text string")
    toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in order], "doc_id bigint, toxic int"))
    want = sorted([i for rank, i in enumerate(order) if rank not in long_ranks][:6])
    assert seen == [([texts[i] for i in want], [i % 2 for i in want])]
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 200)
    seen.clear()
    toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in order], "doc_id bigint, toxic int"))
    assert seen[0][0] == [texts[i] for i in sorted([i for rank, i in enumerate(order) if rank not in long_ranks][:4])]


def test_the_training_sample_keeps_its_bounds():
    assert (toxicity.TRAIN_DOCS, toxicity.TRAIN_BYTES) == (8_000, 32 << 20)


def test_pipeline_stages_keep_what_they_should(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    net = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, net).where("predicted = 1").collect()}
    left = {i: t for i, t in rows.items() if i not in toxic}
    steps = dict(corpus_pipeline.STAGES)
    one = steps["toxicity"](spark, docs, sf)
    assert {r.doc_id for r in one.collect()} == set(left)
    two = steps["exact_dedup"](spark, docs, sf)
    assert {r.doc_id for r in two.collect()} == {i for i, k, *_ in plain.exact(list(rows.items())) if i == k}
    three = steps["near_dedup"](spark, docs, sf)
    want = plain.components(list(rows), plain.near([plain.fingerprint(t) for t in rows.values()]))
    assert {r.doc_id for r in three.collect()} == set(want)
    four = steps["decontamination"](spark, docs, sf)
    bad = {r.doc_id for r in queries.op6_decontaminate(spark, sf).where("contaminated").collect()}
    assert {r.doc_id for r in four.collect()} == set(rows) - bad
    assert all(s.columns == docs.columns for s in (one, two, three, four))
    assert [s[0] for s in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]
    out = corpus_pipeline.run(spark, sf)
    assert held_together(out.collect(), 2048) > 0


def test_items_of_one_repeated_word(spark):
    """A bucket holds equal windows once: time and memory follow the words, not their square."""
    words = ["same"] * 20_000
    (table,) = decontaminate.tables_of([(i, " ".join(words)) for i in range(3)])
    assert sum(map(len, table.buckets.values())) == 1
    spans, items = decontaminate.spans_in([w.encode() for w in words], [table])
    assert spans == [(0, 20_000)] and items == {0, 1, 2}


@pytest.mark.parametrize("size", [1, 60, 400])
def test_a_benchmark_of_many_parts_finds_what_one_part_finds(spark, edge, monkeypatch, size):
    items = [(i, " ".join(f"w{(i * 7 + k) % 40}" for k in range(16))) for i in range(12)] + [(20, "one two three four five"), (None, "same line"), (21, None), (22, "")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    texts = [(100 + i, " ".join(f"w{(i * 5 + k) % 40}" for k in range(30)), "en", None, 1) for i in range(15)]
    docs = edge.unionByName(spark.createDataFrame(texts, edge.schema)).withColumns({"row": F.lit(1), "key": F.lit(2), "all_spans": F.lit("x")})
    columns = ["doc_id", "text", "row", "key", "all_spans", "n_words", "n_hit", "items_sha256", "contaminated"]
    held = [F.to_json(F.struct("spans", "items")).alias("found")]

    def found():
        return Counter(map(tuple, decontaminate.find_items(docs, benchmark).select(*columns, *held).collect()))

    want = found()
    monkeypatch.setattr(decontaminate, "PART_BYTES", size)
    assert found() == want
    assert decontaminate.clean(docs, benchmark).columns == docs.columns


def test_equal_rows_are_dealt_to_all_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_PIECES", 1000)
    docs = spark.range(20_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("a few words").alias("text"))
    packed = packing.pack_documents(docs, queries.vocabulary())
    own = packed.withColumn("bucket", F.shiftright("sequence_id", 32)).groupBy("bucket").count().collect()
    assert len(own) == 20 and max(r["count"] for r in own) < 1300 and sum(r["count"] for r in own) == 20_000


def test_hot_texts_are_broadcast(spark):
    """Texts of a hundred copies and more next to pairs and single ones, with repeated ids and null ids."""
    rows = [(i, f"hot {i % 3}") for i in range(900)] + [(i, f"pair {i // 2}") for i in range(2000, 3200)] + [(i, f"one {i}") for i in range(5000, 5200)]
    rows += [(5, "hot 2"), (None, "hot 1"), (None, "pair 1000"), (2001, "pair 1000")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert bag(exact_dedup.exact_groups(df), *EXACT) == Counter(plain.exact(rows))


CLASHING = ("__key", "__sha", "__kept", "__fp", "__own", "__maybe", "__hash", "__at", "__words", "_host", "_drop", "_stays", "_html")


def test_extra_columns_may_have_the_names_used_inside(edge):
    odd = edge.withColumns({c: F.lit(1) for c in CLASHING})
    assert exact_dedup.keep_one(odd, exact_dedup.exact_groups(odd)).columns == odd.columns
    assert simhash.keep_one(odd, simhash.near_groups(odd)).columns == odd.columns
    assert set(odd.columns) <= set(line_dedup.drop_boilerplate(odd).columns)
