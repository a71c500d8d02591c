"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns; and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lapforge.llm import chat, components, language, mixing, neighbours, packing, registry, sharding, simhash, topk, toxicity

EN, FR = "the of and to in is that it was for with as his on be at by", "le de un et il ne je son que se qui ce dans en du elle au"


def text(rng, words, n):
    return " ".join(rng.choices(words.split(), k=n))


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    rng = random.Random(1)
    rows = [(i, text(rng, EN if i % 2 else FR, rng.randint(3, 80)) + (" vexoid" if i % 7 == 0 else ""), "en" if i % 2 else "fr", f"s{i % 4}", 1, "x", 0.5) for i in range(200)]
    rows += [(300, None, None, None, None, None, None), (None, "null id " + EN, "en", "s1", 1, None, None), (301, "", "en", None, 0, "", 0.0), (302, " \t\n", "en", "s1", 3, "", 0.0), (303, "12 34 !?", "en", "s1", 3, "", 0.0)]
    rows += [(304, text(rng, EN, 60_000), "en", "s1", 1, "x", 0.0), (305, "ÀΣß İ <|endoftext|> x y   ǰ ǰ " + EN, "en", "s0", 1, "x", 0.0)]
    rows += [rows[1]] * 3 + [(306, rows[1][1], "en", "s1", 1, "x", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard string, score double")
    path = str(tmp_path_factory.mktemp("docs"))
    df.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(200)] + [(301, None), (None, 1)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def read(spark, path):
    return spark.read.parquet(f"{path}/documents.parquet")


DOC_QUERIES = ["op1_sharding", "op2_toxicity", "op3_simhash", "op4_language", "op6_maxent", "op7_packing", "op10_mixing"]


@pytest.mark.parametrize("name", DOC_QUERIES)
def test_edges(spark, docs, name):
    got = registry.QUERIES[name](spark, docs).collect()
    ids = Counter(r.doc_id for r in got if getattr(r, "piece", 0) == 0)
    assert ids == Counter(r.doc_id for r in read(spark, docs).select("doc_id").collect())


@pytest.mark.parametrize("name", DOC_QUERIES)
def test_empty(spark, docs, tmp_path, name):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{docs}/{t}.parquet").filter("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert registry.QUERIES[name](spark, str(tmp_path)).collect() == []


def test_sharding():
    names = [f"n{i}" for i in range(10)]
    slots = sharding.fill(names, 1009)
    counts = Counter(slots)
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.fill(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(slots, fewer, strict=True) if a != 9)
    assert moved < 0.25 * 1009
    heavy = Counter(sharding.fill(["a", "b"], 1009, {"a": 3}))
    assert abs(heavy[0] - 3 * heavy[1]) <= 4
    with pytest.raises(ValueError, match="prime"):
        sharding.fill(names, 1000)


def test_crf_marginals_are_exact():
    rng = np.random.default_rng(0)
    model = toxicity.Model(np.zeros(1), rng.normal(size=(2, 2)), rng.normal(size=2), np.zeros(3))
    ends = np.array([0, 5, 5, 8])
    logit = rng.normal(size=8)
    got = toxicity.marginals(logit, ends, model)
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        weight = np.zeros(b - a)
        total = 0.0
        for y in np.ndindex(*[2] * (b - a)) if b > a else []:
            s = model.start[y[0]] + sum(logit[a + k] * v for k, v in enumerate(y)) + sum(model.trans[p, q] for p, q in zip(y, y[1:], strict=False))
            total += np.exp(s)
            weight += np.exp(s) * np.array(y)
        if b > a:
            assert np.allclose(got[a:b], weight / total)


def test_toxicity_finds_the_word(spark, docs):
    got = {r.doc_id: r for r in registry.QUERIES["op2_toxicity"](spark, docs).collect()}
    wrong = [i for i in range(200) if got[i].predicted != int(i % 7 == 0)]
    assert len(wrong) <= 2
    one = got[7]
    assert read(spark, docs).filter("doc_id = 7").first().text[one.spans[-1].start : one.spans[-1].end] == "vexoid"


def test_language(spark, docs):
    got = {r.doc_id: r for r in registry.QUERIES["op4_language"](spark, docs).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "fr") for i in range(200))
    assert {got[i].lang_pred for i in (300, 301, 302, 303)} == {"und"}
    assert all(0 <= r.score <= 1 for r in got.values())


def test_automaton_counts_greedy_phrases():
    rng = np.random.default_rng(3)
    train, doc = rng.integers(0, 3, 60).astype(np.uint8), rng.integers(0, 3, 200).astype(np.uint8)
    table = language.automaton(train, 3)
    got = language.phrases(doc, np.array([0, len(doc)]), table, 3)[0]
    s, n, at = train.tobytes(), 0, 0
    while at < len(doc):
        k = 1
        while at + k < len(doc) and doc[at : at + k + 1].tobytes() in s:
            k += 1
        at, n = at + k, n + 1
    assert got == n


def test_masks_cover():
    ms, rng = simhash.masks(), random.Random(5)
    for _ in range(2000):
        d = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not d & m for m in ms)


def test_simhash_brute_force(spark, tmp_path):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocab) for _ in range(300)] for _ in range(20)]
    rows = []
    for i in range(400):
        words = list(base[i % 20])
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(300)] = rng.choice(vocab)
        rows.append((i, " ".join(words)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in registry.QUERIES["op3_simhash"](spark, str(tmp_path)).collect()}
    fp = np.array([int(got[i].fingerprint, 16) for i in range(400)], dtype=np.uint64)
    changed = True
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
    label = np.arange(400)
    while changed:
        new = np.array([label[near[i]].min() for i in range(400)])
        changed, label = bool((new != label).any()), new
    assert [got[i].component_id for i in range(400)] == label.tolist()


def test_large_bucket_is_cut_into_blocks(spark):
    codes = [0] + [1 << i for i in range(60)] + [(1 << i) | (1 << (i + 1)) for i in range(59)]
    df = spark.createDataFrame([(c, c) for c in codes], "node long, c0 long")
    roots = components.components(simhash.links(df, block=8)).collect()
    assert len(roots) == len(codes) and {r.root for r in roots} == {0}


def shingle_set(words, width=5):
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def test_fingerprint_and_sketch_by_definition():
    rng = random.Random(4)
    for n in (1, 3, 4, 5, 7, 300, 700):
        words = [f"w{rng.randrange(50)}" for _ in range(n)]
        spans = [" ".join(words[i : i + 4]) for i in range(max(1, n - 3))]
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in spans]
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(" ".join(words).encode()) == bits
    assert simhash.fingerprint(b"") == 0 and not simhash.sketch(b" ").any()
    assert (simhash.sketch(b"a b c d e f " * 3) == simhash.sketch(b"a b c d e f " * 9)).all()


def test_near_copy_stage(spark):
    """Of each group of texts of similarity 0.85 or more one stays; every text below 0.6 to all others stays."""
    rng = random.Random(6)
    shared = [f"p{i}" for i in range(60)]
    rows, groups = [], {}
    for g in range(60):
        base = [f"v{rng.randrange(5000)}" for _ in range(rng.randint(150, 400))]
        for c in range(1 + g % 5):
            words = list(base)
            for _ in range(len(words) // 90 if c else 0):
                words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
            assert len(shingle_set(words) & shingle_set(base)) / len(shingle_set(words) | shingle_set(base)) > 0.85
            groups[len(rows)] = g
            rows.append((len(rows), " ".join(words)))
    for k in range(40):
        groups[len(rows)] = 100 + k
        rows.append((len(rows), " ".join([f"u{rng.randrange(5000)}" for _ in range(60)] + shared)))
    rows += [(None, rows[0][1]), (None, "no id"), (None, "nor here"), (7, "another text")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = simhash.stage(df).collect()
    kept = [r.doc_id for r in got if r.doc_id is not None and r.text != "another text"]
    first = {g: min(i for i in groups if groups[i] == g) for g in groups.values()}
    assert sorted(kept) == sorted(first.values())
    assert sorted(r.text for r in got if r.doc_id is None) == ["no id", "nor here"]
    assert [r.doc_id for r in got if r.text == "another text"] == [7]


def test_mixing_without_broadcast(spark, docs, monkeypatch):
    """The walk over steps is joined where it may be too large to be shared; the mix is the same."""
    rows = lambda: sorted(map(repr, registry.QUERIES["op10_mixing"](spark, docs).collect()))
    shared = rows()
    monkeypatch.setattr(mixing, "MOST_SHARED", 0)
    assert rows() == shared


def test_near_copies_at_the_threshold(spark):
    """Pairs under 0.8 stay; of those from 0.8 on 95 % lose a text, all if both have over 8 shingles and 0.82 or more."""
    rng = random.Random(8)
    rows, gone, sure = [], set(), set()
    for k in range(300):
        base = [f"q{rng.randrange(10**5)}" for _ in range(rng.choice([8, 9, 14, 60, 300, 900]))]
        words = base + [f"r{k}.{i}" for i in range(rng.randint(1, max(1, len(base) // 3)))]
        both = shingle_set(base) & shingle_set(words), shingle_set(base) | shingle_set(words)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(words))]
        if 5 * len(both[0]) >= 4 * len(both[1]):
            gone.add(2 * k + 1)
            if len(both[0]) > 8 and len(both[0]) >= 0.82 * len(both[1]):
                sure.add(2 * k + 1)
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in simhash.stage(df).collect()}
    assert kept | gone == {i for i, _ in rows} and 60 < len(sure) < len(gone) < 280
    assert not kept & sure and len(kept & gone) <= 0.05 * len(gone)


def test_near_copies_in_a_large_family(spark, monkeypatch):
    """Of 700 texts at 0.7 to each other only those with a nearer one go; no table has rows for the family's pairs, and blocks of it meet."""
    rng = random.Random(16)
    shared, n = [f"p{i}" for i in range(60)], 700
    tails = [[f"t{i}.{k}" for k in range(12)] for i in range(n)]
    near = {i: tails[i - n][:-2] + [f"n{i}.0", f"n{i}.1"] for i in range(n, n + 80)}
    texts = [shared + t for t in tails] + [shared + t for t in near.values()]
    alike = lambda a, b: len(shingle_set(a) & shingle_set(b)) / len(shingle_set(a) | shingle_set(b))
    assert alike(texts[0], texts[1]) == 0.7 and alike(texts[0], texts[n]) > 0.8
    rng.shuffle(order := list(range(len(texts))))
    df = spark.createDataFrame([(i, " ".join(texts[i]), "en", "s", 1) for i in order], "doc_id long, text string, lang string, source string, n_chars long")
    write, rows = simhash.written, {}

    def counted(table, tag):
        out = write(table, tag)
        rows[tag] = max(rows.get(tag, 0), out.count())
        return out

    monkeypatch.setattr(simhash, "written", counted)
    monkeypatch.setattr(simhash, "BLOCK_HASHES", 10_000)
    assert {r.doc_id for r in simhash.stage(df).collect()} == set(range(n))
    assert rows["asked"] > n / 2 and max(rows.values()) < 124 * len(texts), rows


@pytest.mark.parametrize("block", [8, 1024])
def test_families_meet_in_large_entries(spark, monkeypatch, block):
    """Families are linked as by brute force, and joins by key have a row for each block of an entry at most, none for its members."""
    rng = np.random.default_rng(9)
    start = rng.integers(0, 2**64, (6, simhash.LANES), dtype=np.uint64)
    codes = np.repeat(start, 50, axis=0)
    codes[:, 2] ^= np.uint64(1) << np.arange(300, dtype=np.uint64) % np.uint64(50)  # outside of what tables are built of
    far = codes[150:200]
    far[:, 3:] = rng.integers(0, 2**64, (50, simhash.LANES - 3), dtype=np.uint64)  # they collide but aren't near
    family = np.where(np.arange(300) < 100, 0, np.arange(300) // 2)
    near = np.bitwise_count(codes[:, None] ^ codes[None]).sum(axis=2) <= simhash.NEAR_ALL
    label = family.copy()
    for _ in range(300):
        label = np.array([label[near[i] | (family == family[i])].min() for i in range(300)])
    data = [(i, c.view(np.int64).tolist(), int(f)) for i, (c, f) in enumerate(zip(codes, family, strict=True))]
    frame, joined = type(spark.range(1)), []
    join = frame.join

    def counted(self, other, on=None, how=None):
        out = join(self, other, on, how)
        joined.append(out.count() if on == "key" else 0)
        return out

    monkeypatch.setattr(frame, "join", counted)
    found = simhash._apart(spark.createDataFrame(data, "node long, codes array<long>, family long"), block=block).collect()
    monkeypatch.undo()
    got = dict(zip(range(300), family.tolist(), strict=True))
    for _ in range(300):
        least = {r.a: min(got[x] for x in got if family[x] in (r.a, r.b)) for r in found}
        new = {x: min([v, *(least[r.a] for r in found if family[x] in (r.a, r.b))]) for x, v in got.items()}
        if new == got:
            break
        got = new
    assert list(got.values()) == label.tolist() and len(set(label.tolist())) > 4
    assert sum(joined) <= 124 * len(data) / block + 124 * 6, joined


def test_open_roots_join_the_pairs_once(spark):
    """Two single nodes are decided; all other groups that a pair leaves apart are open. The pairs are joined before, once."""
    pairs = spark.createDataFrame([(1, 2), (3, 4), (4, 5), (6, 7)], "a long, b long")
    placed = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (7, 6)], "node long, root long")
    out = simhash._open_roots(pairs, placed)
    assert sorted(r.root for r in out.collect()) == [3, 4]
    assert not re.search(r"Join.*root_a", out._jdf.queryExecution().optimizedPlan().toString())


def test_components(spark):
    path = [(i, i + 1) for i in range(200)]
    got = components.components(spark.createDataFrame([*path, (500, 501), (501, 500), (7, 7)], "a long, b long")).collect()
    assert {r.root for r in got if r.node < 500} == {0} and {r.node for r in got if r.root == 500} == {500, 501}


def test_maxent_base_scores(spark, docs):
    rows = read(spark, docs).collect()
    train = [r for r in rows if zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 != 1]
    count = Counter()
    for r in train:
        count.update([*(r.text or "").encode().lower().split(), b" "])
    n, v = sum(count.values()), len(count)
    got = {}
    for r in registry.QUERIES["op6_maxent"](spark, docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    for r in rows:
        words = [*(r.text or "").encode().lower().split(), b" "]
        base = sum(np.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        for g in got[r.doc_id]:
            assert (g.n_tokens, g.n_known, g.train_tokens) == (len(words), sum(count[w] > 0 for w in words), n)
            assert np.isclose(g.base_score, base)
            assert g.score < 0
    scores = [g for gs in got.values() for g in gs]
    assert sum(g.score for g in scores) > sum(g.base_score for g in scores)


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    pieces = registry.QUERIES["op7_packing"](spark, docs).collect()
    by = {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
    for r in read(spark, docs).dropDuplicates(["doc_id"]).collect():
        ids = np.array([*tok.encode(r.text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want = {(k, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for k, s in enumerate(range(0, len(ids), 4096))}
        assert {(p.piece, p.start, p.length, p.ids_crc32) for p in by[r.doc_id]} == want
    bins = {}
    for p in pieces:
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in bins.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 4096
    assert len(bins) == -(-sum(p.length for p in pieces) // 4096)
    whole = packing.pieces(read(spark, docs), with_ids=True)
    whole.write.mode("overwrite").parquet(f"{docs}/pieces")
    seqs = packing.sequences(packing.place(spark.read.parquet(f"{docs}/pieces"))).collect()
    assert sum(len(s.ids) for s in seqs) == sum(p.length for p in pieces)


def test_local_search_never_loses_squares():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = rng.integers(1, 60, 80)
        first = packing.best_fit(sizes, 100)
        after = packing.local_search(sizes, first, 100)
        fill = [np.bincount(b, weights=sizes) for b in (first, after)]
        assert fill[1].max() <= 100 and np.count_nonzero(fill[1]) <= np.count_nonzero(fill[0]) and (fill[1] ** 2).sum() >= (fill[0] ** 2).sum()


def test_exchange_is_the_largest_there_is():
    rng = np.random.default_rng(3)
    for _ in range(200):
        own, bins = rng.integers(1, 40, rng.integers(1, 9)), rng.integers(0, 5, rng.integers(1, 15))
        sizes, free = rng.integers(1, 40, len(bins)), rng.integers(0, 30, 5)
        pairs = [int(own[i] + own[j]) for i in range(len(own)) for j in range(i)]
        shifts = [x for x in [*own.tolist(), *pairs] for room in free if x <= room]
        shifts += [x - s for x in [*own.tolist(), *pairs] for s, b in zip(sizes, bins, strict=True) if 0 < x - s <= free[b]]
        order = np.lexsort((sizes, bins))
        twos = [(sizes[a] + sizes[b], bins[a]) for a, b in zip(order[:-1], order[1:], strict=True) if bins[a] == bins[b]]
        shifts += [x - s for x in own.tolist() for s, b in twos if 0 < x - s <= free[b]]
        found = packing._step(own, sizes, free[bins], bins, free)
        assert (found[0] if found else 0) == max(shifts, default=0)
        if found:
            shift, give, got, to = found
            assert len(set(give)) == len(give) and own[give].sum() - sizes[got].sum() == shift <= free[to] and (bins[got] == to).all()


def test_packing_deals_out_until_one_shard_holds_the_rest(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 60)
    spark.range(3_000).select((1 + F.pmod(F.xxhash64("id"), F.lit(60))).alias("length")).write.parquet(f"{tmp_path}/cut")
    bins = {}
    for r in packing.place(spark.read.parquet(f"{tmp_path}/cut"), capacity=100).collect():
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    sizes = [sum(n for _, n in spans) for spans in bins.values()]
    assert sum(map(len, bins.values())) == 3_000 and max(sizes) <= 100
    assert all(o == sum(n for _, n in sorted(spans)[:k]) for spans in bins.values() for k, (o, _) in enumerate(sorted(spans)))
    assert len(bins) <= -(-sum(sizes) // 100) + 1 + 3_000 // 60 * 3 // 10


def test_mixing(spark, docs):
    got = registry.QUERIES["op10_mixing"](spark, docs).collect()
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    assert sum(r.taken for r in got) <= 1.5 * sum(r.size for r in got)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, registry.QUERIES["op10_mixing"](spark, docs).collect()), key=str)


def test_chat_round_trip(spark, tmp_path):
    said = ["plain", "", None, "</s><|x|>[INST] \\ \\\\ </s", "<\\|", "a\nb", "[/INST]</s>", "<<||>>"]
    rows = [(1, t, "assistant" if t % 2 else "user", s) for t, s in enumerate(said)] + [(None, 0, None, "x"), (2, None, "odd|>role\\", "y"), (1, 0, "user", "plain")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in registry.QUERIES["op5_chat"](spark, str(tmp_path)).collect()}
    ordered = [("user", "plain"), ("user", "plain"), *[("assistant" if t % 2 else "user", s or "") for t, s in list(enumerate(said))[1:]]]
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in ordered).encode()).hexdigest()
    assert got[1].loss_chars == sum(len(t) for r, t in ordered if r == "assistant")
    assert got[2].turns_sha256 == hashlib.sha256(b"odd|>role\\\ny\n").hexdigest()
    assert got[-1].n_turns == 2 and None in got
    assert chat.read_back(chat.format_turns(df.filter("false"))).collect() == []


def test_chat_parts():
    parts = [{"kind": "text", "text": "see <|image:0|>"}, {"kind": "image", "ref": "a.png", "width": 28, "height": 15}, {"kind": "audio", "ref": "b", "seconds": 1.5}, {"kind": "document", "ref": "c", "pages": 2}, None]
    turn = chat.format_turn("user", None, parts)
    assert [(a["ref"], a["tokens"]) for a in turn["attachments"]] == [("a.png", 4), ("b", 38), ("c", 512)]
    assert all(turn["formatted"][a["position"] :].startswith(f"<|{a['kind']}:{a['number']}|>") for a in turn["attachments"])
    assert chat.parse_turn(turn["formatted"]) == ("user", "see <|image:0|>")


@pytest.fixture(scope="module")
def vectors(spark, tmp_path_factory):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 64))
    rows = []
    for i in range(600):
        v = base[i % 300] + rng.normal(size=64) * (0.15 if i >= 300 else 0)
        rows.append((i, [float(x) for x in v.astype("f4")], int(i % 300 % 3)))
    rows += [(600, None, 1), (601, [0.0] * 64, 1), (602, [float("nan")] * 64, 1), (603, [None] * 64, 1), (604, rows[0][1], None), (605, rows[0][1], 0), (606, rows[0][1], 0), (607, [], 1), (607, rows[0][1], 1), (608, [1.0, 2.0], 1)]
    path = str(tmp_path_factory.mktemp("vectors"))
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    return path, rows


def test_neighbours_recall(spark, vectors):
    path, rows = vectors
    got = {r.vec_id: r for r in registry.QUERIES["op8_neighbours"](spark, path).filter("vec_id <> 607").collect()}
    good = [r for r in rows if r[1] and len(r[1]) == 64 and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    x = np.array([r[1] for r in good], dtype="f4").astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in good])
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    want = {r[0]: int(n) for r, n in zip(good, near.sum(axis=1), strict=True)}
    assert all(got[i].n_links <= n for i, n in want.items() if i != 607)
    assert sum(got[i].n_links for i in want if i != 607) >= 0.9 * sum(n for i, n in want.items() if i != 607)
    assert all(got[i].n_links == 0 and got[i].kept for i in (600, 601, 602, 603, 604, 608))
    assert got[605].component_id == 0 and got[606].n_links >= 2


def test_topk_brute_force(spark, vectors):
    path, rows = vectors
    good = [(r[0], np.floor(64 * np.array(r[1]))) for r in rows if r[1] and None not in r[1] and np.isfinite(r[1]).all()]
    want = []
    for q, v in good:
        if q % 20 == 0:
            scored = sorted((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v))[:20]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored)]
    got = [tuple(r) for r in registry.QUERIES["op9_topk"](spark, path).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("name", ["op8_neighbours", "op9_topk"])
def test_no_vectors(spark, tmp_path, name):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert registry.QUERIES[name](spark, str(tmp_path)).collect() == []


def test_pipeline(spark, docs):
    seen, now = {}, read(spark, docs).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        before = now
        now = corpus_pipeline.written(stage(spark, now, docs), name)
        seen[name] = {r.doc_id for r in now.select("doc_id").collect()}
        if name != "packing":
            assert now.columns == before.columns
    assert not seen["language"] & {300, 301, 302, 303} and 1 in seen["language"]
    assert 7 not in seen["toxicity"] and 8 in seen["toxicity"]
    assert 306 not in seen["near_copies"] and 1 in seen["near_copies"]
    assert seen["packing"] == seen["mixing"] <= seen["near_copies"]
