"""The operators against brute force, and on empty, NULL, repeated and clashing rows."""

import functools
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from dosewise.llm import ann_tree, components, mixing, packing, pii, quality_fm, simhash, topk, toxicity, url_rules, wordpiece
from dosewise.llm.common import table, word_count
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, fp string, score string"


def odd_docs(spark):
    """NULLs in every column, empty and very long texts, repeated rows, columns that clash with the operators' own."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, None, None, None, None, 1, "x", "y"), (2, "", "en", "a", 0, None, None, None), (3, " \t\n ", "en", "a", 4, 1, "x", "y"),
            (4, long, "en", "b", len(long), 1, "x", "y"), (4, long, "en", "b", len(long), 1, "x", "y"), (None, "some text here", None, None, 3, 1, "x", "y"),
            (5, "Some  TEXT\there", "de", "a", 15, 1, "x", "y"), (6, "caf\u00e9 \U0001f600 mail a.b@c.de now", "fr", "\u00fc", 25, 1, "x", "y")]
    return spark.createDataFrame(rows, DOCS)


# ---------------------------------------------------------------- near-duplicates

def slow_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, ids):
    up = list(range(len(fps)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 3:
            up[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


def test_fingerprints_and_components_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    text = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    ids = sorted(text)
    fps = [slow_fingerprint(text[i]) for i in ids]
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got == dict(zip(ids, zip(fps, slow_components(fps, ids))))


def test_links_at_each_distance(spark):
    rng = random.Random(2)
    fps = set()
    for _ in range(25):
        x = rng.getrandbits(64)
        fps.add(x)
        for flips in (1, 2, 3, 3, 4, 5):
            y = x
            for b in rng.sample(range(64), flips):
                y ^= 1 << b
            fps.add(y)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = simhash.fingerprint_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    root = {r["node"]: r["root"] for r in components.connected_components(links).collect()}
    assert [root.get(x, x) for x in signed] == slow_components(fps, signed)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_of_odd_rows(spark):
    docs = odd_docs(spark)
    got = sorted(map(tuple, simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    assert len(got) == docs.count()
    zero = [r for r in got if r[1] == "0" * 16]
    assert [r[0] for r in zero] == [1, 2, 3] and {r[2] for r in zero} == {1}
    assert {r[2] for r in got if r[0] is None} == {5}  # the same words as document 5
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 4, 5, 6]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_keep_one_decides_each_row_of_a_repeated_id_in_its_own_component(spark):
    copied, lone, other = (" ".join(f"{w}{i}" for i in range(60)) for w in ("copy", "lone", "another"))
    rows = [(2, copied), (5, copied), (5, lone), (7, other), (7, other.upper()), (7, other), (9, lone + " "), (None, "no id at all")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept) == [(-1, "no id at all"), (2, copied), (5, lone), (7, other.upper())]


# ---------------------------------------------------------------- classifiers

def test_factorisation_machine_identity():
    rng = np.random.default_rng(0)
    fm = quality_fm.FactorisationMachine(0.3, rng.normal(size=6), rng.normal(size=(6, 3)), np.zeros(0), np.ones(0))
    x = rng.normal(size=6)
    want = 0.3 + fm.w @ x + sum(fm.v[i] @ fm.v[j] * x[i] * x[j] for i, j in itertools.combinations(range(6), 2))
    assert fm.raw(np.zeros(6, int), np.arange(6), x, 1)[0] == pytest.approx(want)


@pytest.mark.parametrize("module, score, label, least", [
    (quality_fm, quality_fm.score_quality, "quality", 0.97), (toxicity, toxicity.score_toxicity, "toxic", 0.93)])
def test_held_out_accuracy(spark, module, score, label, least):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = score(docs, module.learn(docs, labels)).join(labels, "doc_id").where("held_out")
    right, bad = rows.agg(F.avg((F.col("predicted") == F.col(label)).cast("double")), F.sum((~F.col("score").between(0, 1)).cast("int"))).first()
    assert right >= least and bad == 0


def test_learning_reads_no_held_out_label(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    for module, label, mod, rest in ((quality_fm, "quality", 5, 0), (toxicity, "toxic", 3, 1)):
        fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == rest
        turned = labels.withColumn(label, F.when(fold, 1 - F.col(label)).otherwise(F.col(label)))
        a, b = module.learn(docs, labels), module.learn(docs, turned)
        assert np.array_equal(a.w, b.w) and a.bias == b.bias


def test_classifiers_on_odd_rows_and_without_labels(spark):
    docs, none = odd_docs(spark), table(spark, SF, "labels").limit(0)
    for module, score in ((quality_fm, quality_fm.score_quality), (toxicity, toxicity.score_toxicity)):
        model = module.learn(docs, none)
        got = score(docs, model).collect()
        assert len(got) == docs.count() and {round(r["score"], 9) for r in got} == {0.5}
        assert [r["held_out"] for r in got if r["doc_id"] is None] == [True]
        trained = module.learn(table(spark, SF, "documents"), table(spark, SF, "labels"))
        assert all(0 <= r["score"] <= 1 for r in score(docs, trained).collect())
        assert score(docs.limit(0), model).count() == 0
    assert quality_fm.keep_good(docs, quality_fm.learn(docs, none)).columns == docs.columns


def test_nnpu_finds_the_positives_hidden_in_unlabelled_text():
    rng = np.random.default_rng(1)
    clean = lambda: rng.choice(5000, 30, replace=False) + 100
    toxic = lambda: np.append(clean(), rng.choice(20, 5, replace=False))
    model = toxicity.fit([toxic() for _ in range(150)], [toxic() if i % 10 == 0 else clean() for i in range(600)], 0.1)
    assert (model.score([toxic() for _ in range(200)]) >= 0.7).mean() > 0.9
    assert (model.score([clean() for _ in range(200)]) >= 0.7).mean() < 0.02


# ---------------------------------------------------------------- personal data

PATTERNS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def slow_base(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            twice = [int(x) if i % 2 == 0 else int(x) * 2 - 9 * (x > "4") for i, x in enumerate(reversed(d))]
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                "card": 16 <= len(d) <= 19 and sum(twice) % 10 == 0, "phone": 8 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_base_spans_match_the_plain_patterns(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("a.@1 +-()9.2:%5 1 .4") for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    texts += ["4111 1111 1111 1111", "x@y", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "999.1.1.1", "+1 (202) 555-0101."]
    assert [pii.joined(pii.find(t), pii.BASE) for t in texts] == [slow_base(t) for t in texts]
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want = {r["doc_id"]: slow_base(r["text"]) for r in docs.select("doc_id", "text").collect()}
    for r in pii.digest(pii.find_personal_data(docs)).collect():
        base = want[r["doc_id"]]
        assert r["base_sha256"] == pii.sha256(base) and r["spans"].startswith(base)
        assert [r[f"n_{k}"] for k in pii.BASE] == [base.count(f"{k}:") for k in pii.BASE]


def test_added_kinds_need_checksum_or_context():
    kinds = lambda t: [s[0] for s in pii.find(t)]
    assert kinds("pay to GB82 WEST 1234 5698 7654 32 today") == ["iban"]
    assert kinds("pay to GB83 WEST 1234 5698 7654 32 today") == []
    assert kinds("my ssn is 219-09-9999") == ["ssn"] and kinds("part 219-09-9999") == []
    assert kinds("call 202-555-0101 now") == ["dial"] and kinds("lot 202-555-0101 now") == []
    assert pii.find("card 4111111111111111")[0][3] > pii.find("4111111111111111")[0][3]
    assert pii.masked("mail a@b.cd, +1 (202) 555-0101", pii.find("mail a@b.cd, +1 (202) 555-0101")) == "mail [EMAIL], [PHONE]"


def test_personal_data_in_odd_and_long_rows(spark):
    docs = odd_docs(spark)
    got = {r["doc_id"]: r for r in pii.digest(pii.find_personal_data(docs)).collect()}
    assert got[6]["spans"] == "email:12:20" and got[1]["spans"] == "" and got[None]["n_email"] == 0
    masked = {r["doc_id"]: r for r in pii.mask(docs).collect()}
    assert masked[6]["text"] == "caf\u00e9 \U0001f600 mail [EMAIL] now" and masked[6]["n_chars"] == len(masked[6]["text"]) and masked[1]["text"] is None
    assert pii.mask(docs.limit(0)).count() == 0
    for hard in ("9" * 100_000, "a" * 100_000, "1." * 50_000, "+1" + "(" * 50_000, "@" * 100_000, "a@b" * 30_000, "call 202-555-0101 or a@b.cd, " * 20_000):
        pii.find(hard)  # linear


def test_added_spans_that_overlap_base_spans_are_dropped():
    rng = random.Random(8)
    parts = ["call ", "202-555-0101", "+1 202-555-0101", "4111 1111 1111 1111", "a@b.cd", " 1.2.3.4 ", "ssn 219-09-9999", "x@219-09-9999.com", "GB82 WEST 1234 5698 7654 32", " "]
    for _ in range(500):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))
        found = pii.find(t)
        base = [(a, b) for k, a, b, _ in found if k in pii.BASE]
        every = {(k, a, b) for k, a, b in pii._shapes(t)}
        for k, a, b, _ in found:
            assert (k, a, b) in every and (k in pii.BASE or all(b <= x or y <= a for x, y in base))
        assert [s for s in pii.joined(found, pii.BASE).split(",") if s] == [s for s in slow_base(t).split(",") if s]


# ---------------------------------------------------------------- token counts

def test_token_counts_match_greedy_matching(spark):
    vocabulary = set(wordpiece.read_vocabulary(wordpiece.VOCABULARY))
    longest = max(map(len, vocabulary))

    def greedy(word):
        s, at, n = b" " + word, 0, 0
        while at < len(s):
            at = next(j for j in range(min(len(s), at + longest), at, -1) if s[at:j] in vocabulary)
            n += 1
        return n

    docs = table(spark, SF, "documents")
    want = {r["doc_id"]: r["text"].encode().split() for r in docs.collect()}
    for r in wordpiece.token_counts(docs).collect():
        assert (r["n_words"], r["n_tokens"]) == (len(want[r["doc_id"]]), sum(map(greedy, want[r["doc_id"]])))
    odd = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in wordpiece.token_counts(odd_docs(spark)).collect()}
    assert odd[1] == odd[2] == odd[3] == (0, 0) and odd[5][0] == 3 and wordpiece.token_counts(odd_docs(spark).limit(0)).count() == 0


def test_automaton_of_a_small_vocabulary():
    singles = [bytes([b]) for b in range(256)]
    counter = wordpiece.build([*singles, b" a", b"abcd", b"bcde", b"cd", b" abcx", b"dddd"]).counter()
    assert counter.word(b"abcdddd") == 6  # " a" "b" "cd" "d" "d" "d"
    assert counter.word(b"abc") == 3 and counter.word(b"abcx") == 1
    with pytest.raises(ValueError):
        wordpiece.build([b"a"])


# ---------------------------------------------------------------- vector searches

def vectors(spark, n=700, d=12, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=d)]) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(30)]  # ties
    rows += [(9000, None), (9020, [0.0] * d), (9040, [float("nan")] * d), (9060, [None] + [1.0] * (d - 1)), (9080, [1.0]), (9100, []), (None, rows[1][1]), (7, rows[7][1])]
    return spark.createDataFrame([(i, v, "label") for i, v in rows], "vec_id long, embedding array<float>, score string")


def valid(frame, zero):
    """(id, vector) of every row that takes part; rows of one id are rows each."""
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect() if r["vec_id"] is not None and r["embedding"] and len(r["embedding"]) > 1]
    rows = [(i, np.array(v, float)) for i, v in rows if None not in v and np.isfinite(np.array(v, float)).all()]
    return sorted(((i, v) for i, v in rows if zero or v.any()), key=lambda r: (r[0], r[1].tolist()))


def slow_top_k(frame):
    rows = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in valid(frame, True)]
    want = []
    for n, (q, query) in enumerate(rows):
        if q % 100 == 0:
            s = sorted((-sum(a * b for a, b in zip(query, v)), i) for m, (i, v) in enumerate(rows) if m != n)
            want += [(q, k + 1, i, -x) for k, (x, i) in enumerate(s[:10])]
    return sorted(want)


def test_exact_top_k(spark):
    frame = vectors(spark)
    assert sorted(map(tuple, topk.top_k(frame).collect())) == slow_top_k(frame)
    assert topk.top_k(frame.limit(0)).count() == 0


def test_rows_of_one_id_are_queries_and_candidates_each(spark, tmp_path):
    from dosewise.checks.compare import compare, duck_connect
    from dosewise.llm import oracles

    rng = np.random.default_rng(9)
    rows = [(i // 3 * 20, rng.normal(size=4).tolist()) for i in range(60)] + [(0, [1.0, 1.0, 1.0, 1.0])] * 3
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(frame)
    assert sorted(map(tuple, got.collect())) == slow_top_k(frame)
    duck = duck_connect(SF)
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    duck.execute(f"CREATE OR REPLACE TEMP VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert compare(got, duck, oracles.OP10)["match"]
    near = Counter(r["query_id"] for r in ann_tree.nearest(frame).collect())
    assert near == {q: 20 * n for q, n in Counter(i for i, _ in rows).items()}
    pair = spark.createDataFrame([(0, [1.0, 2.0]), (0, [3.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, ann_tree.nearest(pair).collect())) == [(0, 1, 0, 5.0)] * 2


def test_nearest_neighbours_recall_and_scores(spark):
    frame = vectors(spark, 4000).dropDuplicates(["vec_id"])
    rows = dict(valid(frame, False))
    got = {}
    for r in ann_tree.nearest(frame).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    assert set(got) == {i for i in rows if i % 20 == 0}
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1)) and q not in [f[1] for f in found]
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        for _, i, s in found:
            assert s == functools.reduce(lambda t, ab: t + ab[0] * ab[1], zip(rows[q].tolist(), rows[i].tolist()), 0.0)
        best = sorted((-float(rows[q] @ v), i) for i, v in rows.items() if i != q)[:20]
        hits += len({i for _, i in best} & {f[1] for f in found})
        total += 20
    assert hits / total >= 0.9
    assert ann_tree.nearest(frame.limit(0)).count() == 0


def test_queries_in_small_leaves_get_full_lists(spark, monkeypatch):
    monkeypatch.setattr(ann_tree, "LEAF_ROWS", 4)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 8))
    rows = [(i, (centres[i % 60] + 1e-4 * rng.normal(size=8)).tolist()) for i in range(300)]
    got = ann_tree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), target=0.05).collect()
    lists = Counter(r["query_id"] for r in got)
    assert lists == {q: 20 for q in range(0, 300, 20)}


def test_fewer_candidates_than_k(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0]), (20, [0.5, 0.5]), (1, [3.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann_tree.nearest(few).sort("query_id", "rank").collect()] == [(0, 1, 1, 5.0), (0, 2, 20, 1.5), (20, 1, 1, 2.0), (20, 2, 0, 1.5)]
    assert [r["vec_id"] for r in topk.top_k(few).sort("rank").collect()] == [1, 20]


# ---------------------------------------------------------------- packing

def slow_pack(sizes, sources, clusters, capacity):
    bins, out, rests = [], [], []
    for row, size in enumerate(sizes):
        at = 0
        while size - at > capacity:
            out.append((row, at, capacity, len(bins)))
            bins.append([0, set(), set()])
            at += capacity
        rests.append((size - at, row, at))
    for size, row, at in sorted(rests, key=lambda r: (-r[0], r[1])):
        fits = [(b[0], i) for i, b in enumerate(bins) if b[0] >= size and b[0] and sources[row] not in b[1] and clusters[row] not in b[2]]
        if fits:
            i = min(fits)[1]
        else:
            i = len(bins)
            bins.append([capacity, set(), set()])
        bins[i][0] -= size
        bins[i][1] |= {sources[row]} - {None}
        bins[i][2] |= {clusters[row]} - {None}
        out.append((row, at, size, i))
    return out


def test_packing_matches_a_plain_scan():
    rng = random.Random(6)
    for _ in range(300):
        sizes = sorted((rng.choice([0, 1, 5, rng.randint(0, 60)]) for _ in range(rng.randint(0, 60))), reverse=True)
        sources, clusters = [rng.choice([None, *"abcd"]) for _ in sizes], [rng.choice([None, *range(20)]) for _ in sizes]
        assert packing.pack_shard(sizes, sources, clusters, 20) == slow_pack(sizes, sources, clusters, 20)


def test_packed_documents_are_whole_and_keep_constraints(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").union(odd_docs(spark).select("doc_id", "text", "lang", "source", "n_chars"))
    words, rows = docs.agg(F.sum(word_count(F.col("text"))), F.count("*")).first()
    packed = packing.pack(docs)
    assert packed.agg(F.sum("words")).first()[0] == words and packed.where("first_word = 0").count() == rows
    assert packed.groupBy("shard", "bin").agg(F.sum("words").alias("w"), F.max("bin_words").alias("b")).where("w > 2048 OR w <> b").count() == 0
    part = packed.where("words < 2048").join(docs.select("doc_id", "source").distinct(), "doc_id").where("source IS NOT NULL")
    assert part.groupBy("shard", "bin", "source").count().where("count > 1").count() == 0
    assert packing.pack(docs.limit(0)).count() == 0


def test_many_equal_rows_are_packed_in_bounded_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 50)
    docs = spark.createDataFrame([(1, "a b c", "s")] * 400, "doc_id long, text string, source string")
    packed = packing.pack(docs, cluster=F.lit(1))
    assert packed.count() == 400 == packed.select("shard", "bin").distinct().count()


# ---------------------------------------------------------------- mixing

def test_targets_by_repeated_sharing(spark):
    sizes = {"a": 1000, "b": 5, "c": 300, "d": 0, "e": 44, None: 70, "\U0001f600": 9, "\uffff": 8}
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, left, free = {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            want[s] = 2 * sizes[s]
            left -= 2 * sizes[s]
        free -= over
    assert got == pytest.approx(want | share)


def test_splitting_tree_conserves_quotas_and_has_the_right_spread(spark):
    quotas = [5000, 30, 0, 1, 700, 12000]
    tree = mixing.split_tree(spark.createDataFrame(list(enumerate(quotas)), "source_no long, blocks long"), 6).toPandas()
    assert tree.groupby("source_no").blocks.sum().tolist() == quotas and tree.blocks.min() >= 0
    assert tree.groupby("shard").blocks.sum().max() - tree.groupby("shard").blocks.sum().min() <= 1
    share = quotas[0] / sum(quotas)
    deviation = np.sqrt(sum(quotas) / 64 * share * (1 - share))  # of a shard's draw, nearly
    assert 0.7 * deviation < tree[tree.source_no == 0].blocks.std() < 1.3 * deviation
    again = mixing.split_tree(spark.createDataFrame(list(enumerate(quotas)), "source_no long, blocks long"), 6).toPandas()
    assert tree.sort_values(["shard", "source_no"]).blocks.tolist() == again.sort_values(["shard", "source_no"]).blocks.tolist()


def test_mix_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 1 << 12)
    docs = odd_docs(spark)
    got = mixing.mix_digest(docs).collect()
    assert len(got) == docs.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    pieces, _ = mixing.mix_plan(docs)
    assert pieces.groupBy("_source", "_bucket", "_row", "epoch", "first").count().where("count > 1").count() == 0
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.dtypes == docs.dtypes
    assert mixed.agg(F.sum(word_count(F.col("text")))).first()[0] == sum(r["taken"] for r in got)
    assert mixing.mix_digest(docs.limit(0)).count() == 0 == mixing.mixed_documents(docs.limit(0)).count()


@pytest.mark.parametrize("sizes", [(8,), (1, 2, 5, 13, 40)])
def test_mixed_documents_come_in_the_shards_and_slots_of_the_tree(spark, monkeypatch, sizes):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 8)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 512)
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(sizes[i % len(sizes)])), "en", "aaaabbbcd"[i % 9], None) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    _, sources, words = mixing.streams(docs)
    depth = (words - 1).bit_length() - 9
    number = {r["source"]: r["source_no"] for r in sources.collect()}
    take = {r["source_no"]: r["take"] for r in sources.collect()}
    quota, last, run = {}, Counter(), {}
    for r in sorted(mixing.split_tree(sources.select("source_no", "blocks"), depth).collect()):
        s, n = r["source_no"], r["blocks"]
        quota[r["shard"], s] = min((last[s] + n) * 8, take[s]) - min(last[s] * 8, take[s])
        run |= {(s, b): r["shard"] for b in range(last[s], last[s] + n)}
        last[s] += n
    assert depth >= 3 and len({shard for shard, _ in quota}) == 1 << depth
    out = [(r["doc_id"], len(r["text"].split()), number[r["source"]]) for r in mixing.mixed_documents(docs).collect()]
    planned = [(r["_doc"]["doc_id"], r["took"], r["source_no"], r["shard"], r["slot"], r["begin"], r["block"]) for r in mixing.mixed_rows(docs).collect()]
    planned.sort(key=lambda r: (r[3], r[4], r[2], r[5]))
    assert out == [r[:3] for r in planned]  # the output's order is the plan's
    assert all(run[s, block] == shard and block == begin // 8 for _, _, s, shard, _, begin, block in planned)
    total = Counter()
    for (_, took, s), (_, _, _, shard, *_) in zip(out, planned):
        total[shard, s] += took
    off = max(abs(total[k] - quota[k]) for k in quota)
    assert off == 0 if sizes == (8,) else off < max(sizes)
    firsts = {(r["doc_id"], r["epoch"]): r["shard"] for r in (lambda p, d: p.where("first = 0").join(d.select("_source", "_bucket", "_row", F.col("_id").alias("doc_id")), ["_source", "_bucket", "_row"]))(*mixing.mix_plan(docs)).collect()}
    assert Counter((d, shard) for (d, _), shard in firsts.items()) == Counter((r[0], r[3]) for r in planned)
    blocks = list(dict.fromkeys((r[3], r[2], r[6]) for r in planned))
    assert blocks != sorted(blocks)  # shuffled within the shards


# ---------------------------------------------------------------- URL rules

def test_url_parts_lists_and_rules(spark):
    cases = [("http://WWW.Example.NET/en/x?q=1", "www.example.net", "/en/x", "example.net/en/", "allow"), ("https://a.net", "a.net", "", None, "allow"),
             ("https://a.net/", "a.net", "/", "net/", "block"), ("x://example.com/de/1#f", "example.com", "/de/1", "example.com/de/", "block"),
             ("x://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"), ("x://b.org/fr/?u=http://c.net/", "b.org", "/fr/", "org/fr/", "allow"),
             ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow")]
    pages = spark.createDataFrame([(i, c[0], "x", "y") for i, c in enumerate(cases)] + [(None, "y://z.net/a", None, None)], "page_id long, url string, host string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in url_rules.judge(pages).collect()}
    assert got == {i: c[1:4] for i, c in enumerate(cases)} | {None: ("z.net", "/a", "net/")}
    assert url_rules.judge(pages.limit(0)).count() == 0
    examples = spark.createDataFrame([(["h:x", "p:a"], "block")] * 6 + [(["h:x", "p:b"], "allow")] * 6 + [(["h:y", "p:a"], "allow")] * 2, "tokens array<string>, label string")
    rules = url_rules.mine(examples)
    assert {(r[0], r[1], round(r[2], 2)) for r in rules} == {((("h:x",), ("p:a",)), "block", 1.0), ((("p:b",),), "allow", 1.0), ((("h:y",),), "allow", 1.0)}
    index = url_rules.inverted_index(rules)
    assert url_rules.best_rule(["p:a", "h:x", "q:z"], index) == ("block", "h:x p:a") and url_rules.best_rule(["p:a"], index) == (None, None)


def slow_rules(examples, support, confidence):
    """Every subset of every example that passes support and confidence, and no smaller one makes needless."""
    n, held = len(examples), Counter()
    both = Counter()
    for tokens, label in examples:
        for k in range(1, len(tokens) + 1):
            for s in itertools.combinations(sorted(tokens), k):
                held[s] += 1
                both[s, label] += 1
    sure = {(s, label): c / held[s] for (s, label), c in both.items() if c >= np.ceil(support * n) and c / held[s] >= confidence}
    return {(s, label): c for (s, label), c in sure.items() if not any(sure.get((t, label), 0) >= c for k in range(1, len(s)) for t in itertools.combinations(s, k))}


def test_rules_of_any_length_match_brute_force(spark):
    rng = random.Random(6)
    for seed in range(3):
        names = [f"p:{c}" for c in "abcdefg"]
        examples = []
        for _ in range(120):
            tokens = {t for t in names if rng.random() < 0.6} | {"s:x"}
            tokens |= {"h:one", "h:two"} if "p:a" in tokens and seed else set()  # together with p:a only
            examples.append((sorted(tokens), "block" if {"p:b", "p:c", "p:d"} <= tokens or rng.random() < 0.05 else "allow"))
        rules = url_rules.mine(spark.createDataFrame(examples, "tokens array<string>, label string"), 0.05, 0.8)
        got = {(tuple(sorted(pick)), r[1]): r[2] for r in rules for pick in itertools.product(*r[0])}
        want = slow_rules(examples, 0.05, 0.8)
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
        assert any(len(k) >= 3 and label == "block" for k, label in got)
        index = url_rules.inverted_index(rules)
        n = len(examples)
        for _ in range(60):
            page = [t for t in [*names, "h:one", "h:two", "q:z"] if rng.random() < 0.5]
            fits = [(-c, -sum(set(a) <= set(t) and y == label for t, y in examples) / n, label != "block", list(a), label) for (a, label), c in want.items() if set(a) <= set(page)]
            best = min(fits, default=None)
            assert url_rules.best_rule(page, index) == ((best[4], " ".join(best[3])) if best else (None, None))


def test_a_long_template_is_one_item(spark):
    template = [f"p:{i:02d}" for i in range(30)]
    examples = [([*template, "h:a"], "block")] * 40 + [(["h:b", "p:x"], "allow")] * 60
    rules = url_rules.mine(spark.createDataFrame(examples, "tokens array<string>, label string"))
    assert {(r[0], r[1]) for r in rules} == {(((("h:a", *template)),), "block"), ((("h:b", "p:x"),), "allow")}
    assert url_rules.best_rule(["p:07", "p:29"], url_rules.inverted_index(rules)) == ("block", "p:07")


# ---------------------------------------------------------------- toxicity: risk and copies

def test_pu_risk_and_gradient_are_those_of_the_formula():
    rng = np.random.default_rng(2)
    pos, prior = np.arange(12) < 5, 0.3
    weight = np.where(pos, 0.2, 1 / 7)
    soft = lambda x: np.log1p(np.exp(x))
    for shift in (0.0, -6.0):  # far below zero, U's risk is corrected to less than nothing
        f = rng.normal(size=12) + np.where(pos, -shift, shift)
        r_p, r_pn, r_un = soft(-f[pos]).mean(), soft(f[pos]).mean(), soft(f[~pos]).mean()
        risk, grad = toxicity.pu_risk(f, pos, weight, prior)
        assert risk == pytest.approx(prior * r_p + max(0, r_un - prior * r_pn))

        def value(f):
            plain = soft(f[~pos]).mean() - prior * soft(f[pos]).mean()
            return prior * soft(-f[pos]).mean() + plain if shift == 0 else -plain

        assert (r_un - prior * r_pn < 0) == (shift < 0)
        for i in range(12):
            e = np.zeros(12)
            e[i] = 1e-5
            assert (value(f + e) - value(f - e)) / 2e-5 == pytest.approx(grad[i], abs=1e-6)


def test_near_copies_share_the_weight_of_one_example():
    rng = np.random.default_rng(3)
    base = [np.unique(rng.integers(0, 1 << 17, 120)) for _ in range(4)]
    shared = base[1][:2]  # two features in common make no copies
    docs = [base[0], base[0], np.append(base[0][3:], [7, 8]), base[1], np.append(base[2], shared), base[3], np.zeros(0, np.int64), np.zeros(0, np.int64)]
    assert toxicity.copy_weights(docs).tolist() == [1 / 3] * 3 + [1.0] * 3 + [0.5] * 2
    assert toxicity.copy_weights([]).tolist() == []
    many = [np.append(base[0][5:], rng.integers(0, 1 << 17, 3)) for _ in range(400)] + [base[1]]
    weights = toxicity.copy_weights(many)
    assert weights[-1] == 1.0 and weights[:-1].sum() == pytest.approx(1.0)


def test_toxicity_recall_and_precision_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = toxicity.score_toxicity(docs, toxicity.learn(docs, labels)).join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    both = sum(r["toxic"] and r["predicted"] for r in rows)
    assert both / sum(r["toxic"] for r in rows) >= 0.85 and both / sum(r["predicted"] for r in rows) >= 0.8
