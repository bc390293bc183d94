"""The training-data operators against plain versions, libraries and planted cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("kinetrail.llm")
import brute  # noqa: E402

from kinetrail.llm import chat_format, decontaminate, embedding_dedup, jaccard_join, language_id, line_dedup, queries, token_counts, toxicity, word_bpe  # noqa: E402

DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, **more):
    return spark.createDataFrame([(i, t, more.get("lang", "en"), more.get("source", "a"), len(t or "")) for i, t in enumerate(texts)], DOC)


def corpus(seed=1, n=300):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    base = [" ".join(r.choice(vocab) for _ in range(r.choice([3, 5, 7, 9, 12, 16, 40, 90]))) for _ in range(n)]
    hub = " ".join(r.choice(vocab) for _ in range(40)).split()
    out = []
    for t in base:
        w = t.split()
        out.append(t)
        for _ in range(r.choice([0, 0, 1, 3])):
            v = w[:]
            v[r.randrange(len(v))] = r.choice(vocab)
            out.append(" ".join(v))
    for _ in range(90):  # near copies of one text, each with its own changes
        v = hub[:]
        for _ in range(r.choice([0, 1, 2])):
            v[r.randrange(len(v))] = r.choice(vocab)
        out.append(" ".join(v) + r.choice(["", " tail", " other tail"]))
    return out + [None, "", " \n", "A b C d E", "a B c D e", out[0], out[0]]


def test_jaccard_matches_brute_force(spark):
    texts = corpus()
    got = sorted(map(tuple, jaccard_join.jaccard_components(docs_of(spark, texts)).collect()))
    assert got == brute.jaccard(list(enumerate(texts)))


def test_jaccard_empty_and_repeated(spark):
    empty = docs_of(spark, [])
    assert jaccard_join.jaccard_components(empty).count() == 0
    rows = spark.createDataFrame([(5, "one two three"), (5, "one two three"), (None, "one two three"), (9, None)], "doc_id long, text string")
    got = jaccard_join.jaccard_components(rows).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.component_id) for r in got) == [(-1, 5), (5, 5), (5, 5), (9, 9)]


def test_light_boundary_follows_cost():
    assert jaccard_join.light_boundary({3: 1000}, 0.1, 75) in range(jaccard_join.LIGHT_MOST + 1)
    # sets of 8 leave the lists once the boundary passes 8 / 0.75
    assert jaccard_join.light_boundary({8: 1000}, 0.0, 75) == 0
    assert jaccard_join.light_boundary({8: 1000}, 1e6, 75) >= 10


ODD = ["", "  ", " a\x1cb", "<|endoftext|>foo<|startoftext|> bar", "I'LL don't We'RE 'S 'lx 'll're'", "ΑΣ Σ ΣΑ", "İstanbul ǅ", "é ́x", "aaaa aaaaaaaa", "123 ½²x٣", "日本語 🙂🙂 👩‍👩‍👧", "​zero nb　x\x85y", "'", "''s!'s", "x" * 3000]


def test_bpe_equals_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(word_bpe.default_vocabulary())
    texts = ODD + [r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").select("text").collect()]
    want = lib.encode_batch(texts, add_special_tokens=False)
    got = {r.doc_id: r for r in word_bpe.encode(docs_of(spark, [*texts, None])).collect()}
    digest = {r.doc_id: r for r in word_bpe.encode_digest(docs_of(spark, [*texts, None])).collect()}
    for i, w in enumerate(want):
        assert got[i].ids == w.ids
        shown = lib.decode(w.ids, skip_special_tokens=False)
        assert got[i].decoded == shown
        assert digest[i].ids_sha256 == hashlib.sha256(np.array(w.ids, "<u4").tobytes()).hexdigest()
        assert digest[i].decoded_sha256 == hashlib.sha256(shown.encode()).hexdigest()
    assert got[len(texts)].ids == [] and digest[len(texts)].n_tokens == 0


def test_token_files(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(word_bpe.default_vocabulary())
    got = sorted(word_bpe.token_files(docs_of(spark, [*ODD, None])).collect())
    at = 0
    for r, t in zip(got, [*ODD, ""]):
        ids = [*lib.encode(t, add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert word_bpe.token_files(docs_of(spark, [])).count() == 0


def plain_unigram(counter, word):
    score = dict(zip(counter.keys.tolist(), counter.score.tolist()))
    best = [(0.0, 0)] + [(-np.inf, 0)] * len(word)
    for e in range(1, len(word) + 1):
        for s in range(max(0, e - counter.longest), e):
            k = int(counter._hash(token_counts._codes(word[s:e])))
            if k in score:
                x, n = best[s][0] + score[k], 1
            elif e - s == 1:
                x, n = best[s][0] + counter.unknown, len(word[s].encode())
            else:
                continue
            if x > best[e][0]:
                best[e] = (x, best[s][1] + n)
    return best[-1][1]


def test_token_counts_equal_plain_forward_pass(spark):
    texts = [t for t in ODD if len(t) < 100] + ["the thing then them", "a  b ", "▁x", "foo\nbar"]
    counter = token_counts.UnigramCounter(token_counts.default_vocabulary())
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs_of(spark, [*texts, None])).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (plain_unigram(counter, "▁" + t.replace(" ", "▁")) if t else 0), t
    assert got[len(texts)] == 0


def test_language_id(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None, "x", 0), (10**6 + 1, "123 ... 456", None, "x", 3), (10**6 + 2, "", "en", "x", 0)], DOC)
    rows = language_id.language_id(d.union(extra)).selectExpr("doc_id", "lang", "lang_pred", "score", "crc32(cast(doc_id as string)) % 4 = 2 as h").collect()
    held = [r for r in rows if r.h and r.doc_id < 10**6]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id >= 10**6)
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in language_id.language_id(docs_of(spark, ["abc"]).selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}


def test_language_sample_holds_different_texts(spark):
    rows = [(4 * i, "the same words again" if i % 3 else f"text {i} of its own", "en", "a", 9) for i in range(9000)]
    rows += [(4 * i, f"eigener Text {i}", "de", "a", 9) for i in range(30)]
    got = language_id.sample(spark.createDataFrame(rows, DOC))
    assert [sum(r.lang == x for r in got) for x in ("en", "de")] == [language_id.PER_LANGUAGE, sum(zlib.crc32(str(4 * i).encode()) % 4 != 2 for i in range(30))]
    assert len({(r.lang, tuple(r.parts)) for r in got}) == len(got)


def test_gru_gradients():
    net = language_id.ByteGRU(["a", "b"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    seq, label, mask = rng.integers(0, 256, (5, 3)).astype(np.uint8), np.array([0, 1, 1]), np.ones((5, 3))
    g = net.gradients(seq, label, mask)

    def loss():
        out, _ = net.states(seq, False)
        p = net.probabilities(out)
        return -np.log(p[:, label, np.arange(3)]).mean()

    for name in g:
        i = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        old = net.p[name][i]
        net.p[name][i] = old + 1e-2
        up = loss()
        net.p[name][i] = old - 1e-2
        down = loss()
        net.p[name][i] = old
        assert abs((up - down) / 2e-2 - g[name][i]) < 2e-3 + 0.05 * abs(g[name][i]), name


def test_toxicity_held_out(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    net = toxicity.fit(d, lab)
    rows = toxicity.toxicity(d, net).join(lab, "doc_id").join(d.select("doc_id", "lang"), "doc_id").where("crc32(cast(doc_id as string)) % 4 = 2").collect()
    for lang in ("en", "de", "fr", "es"):
        of = [[r.predicted for r in rows if r.lang == lang and r.toxic == x] for x in (0, 1)]
        assert np.mean(of[1]) >= 0.9 and np.mean(of[0]) <= 0.05, (lang, np.mean(of[1]), np.mean(of[0]))
    odd = toxicity.toxicity(docs_of(spark, [None, "", "..."]), net).collect()
    assert all(0 <= r.score <= 1 for r in odd)
    assert all(r.score == 0 for r in toxicity.toxicity(docs_of(spark, ["x"]), None).collect())


def test_toxicity_learns_behind_a_long_prefix(spark):
    """The telling words stand behind 6,000 characters that are alike in both labels."""
    texts = [" ".join(f"word{j % 20}" for j in range(1100)) + (" vile scum begone" if i % 2 else " kind folk welcome") for i in range(400)]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, toxicity.fit(docs, labels)).where("crc32(cast(doc_id as string)) % 4 = 2").collect()
    assert np.mean([r.predicted == r.doc_id % 2 for r in rows]) > 0.95


def test_cnn_gradients():
    """One step of plain gradient descent on the loss, against differences, for the last layer, a filter and an embedding."""
    rng = np.random.default_rng(2)
    net = toxicity.ToxicCNN()
    net.v[:] = rng.normal(0, 0.5, len(net.v))
    words = [rng.integers(0, 2**63, (n, 1 + len(toxicity.STEMS))).astype(np.uint64) for n in (9, 4)]
    at, label = np.array([0, 9, 13]), np.array([1.0, 0.0])
    ids = toxicity.buckets(np.concatenate(words))

    def loss():
        feat, _ = net.maxima(ids, at)
        z = (feat @ net.v + net.c).astype(float)
        return float(np.mean(np.log1p(np.exp(-z)) * label + np.log1p(np.exp(z)) * (1 - label)))

    feat, where = net.maxima(ids, at)
    d = (1 / (1 + np.exp(-(feat @ net.v + net.c))) - label) / 2
    k = 2
    n = toxicity.WIDTHS.index(k)
    width = toxicity.FILTERS * toxicity.TOP
    g = (d[:, None] * net.v)[:, n * width : (n + 1) * width].reshape(2, toxicity.FILTERS, toxicity.TOP)
    for f in range(toxicity.FILTERS):  # the filter's second word, first component
        want = sum(g[i, f, r] * net.e[ids[:, where[n][i, f, r] + 1]].sum(axis=0)[0] for i in range(2) for r in range(toxicity.TOP) if where[n][i, f, r] >= 0)
        old = net.w[k][1, 0, f]
        net.w[k][1, 0, f] = old + 1e-2
        up = loss()
        net.w[k][1, 0, f] = old - 1e-2
        down = loss()
        net.w[k][1, 0, f] = old
        assert abs((up - down) / 2e-2 - want) < 2e-3 + 0.05 * abs(want)


def test_top_responses_equal_a_sort():
    rng = np.random.default_rng(4)
    y, at = rng.integers(0, 6, (60, 3)).astype(np.float32), np.array([2, 7, 9, 30])
    value, where = toxicity.top_responses(y.copy(), at)
    for i, (a, b) in enumerate(zip(at, [*at[1:], 60])):
        for f in range(3):
            want = sorted(((-y[j, f], j) for j in range(a, b)))[: toxicity.TOP]
            got = [(-v, w) for v, w in zip(value[i, f], where[i, f])][: len(want)]
            assert got == want


def test_embedding_dedup(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 16))
    rows = [b for b in base] + [base[0] + 0.05 * rng.standard_normal(16) for _ in range(150)] + [base[1]] * 40 + [base[2] * 3.0] * 2
    x = np.stack(rows).astype(np.float32)
    bad = [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16), (1004, []), (1005, [float("inf")] + [0.0] * 15)]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + bad, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in embedding_dedup.embedding_dedup(df).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    s = u @ u.T >= 0.9
    np.fill_diagonal(s, False)
    want = s.sum(axis=1)
    assert all(got[i].n_links <= want[i] for i in range(len(x)))
    assert sum(got[i].n_links for i in range(len(x))) >= 0.98 * want.sum()
    assert all(got[i].n_links == 0 and got[i].kept and got[i].component_id == i for i, _ in bad)


def test_embedding_windows_of_few_vectors(spark):
    """Fewer vectors of a length than a window holds, over several partitions: every link is found."""
    rng = np.random.default_rng(5)
    vectors = [rng.standard_normal(d) * 0.3 + np.ones(d) for d in (4, 5, 7) for _ in range(20)]
    got = embedding_dedup.embedding_dedup(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"))
    unit = [v / np.linalg.norm(v) for v in vectors]
    want = {i: sum(j != i and len(u) == len(w) and bool(u @ w >= 0.9) for j, w in enumerate(unit)) for i, u in enumerate(unit)}
    assert {r.vec_id: r.n_links for r in got.collect()} == want


def test_embedding_recall_of_isolated_pairs(spark):
    """Pairs at cosine just over 0.9, far from all others, among 20,000 vectors."""
    rng = np.random.default_rng(7)
    x = rng.standard_normal((20000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((2000, 64))
    z -= (z * x[:2000]).sum(axis=1, keepdims=True) * x[:2000]
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    x[-2000:] = 0.9001 * x[:2000] + np.sqrt(1 - 0.9001**2) * z
    df = spark.createDataFrame([(i, 64, v.tolist()) for i, v in enumerate(x)], "rid long, dim int, embedding array<double>")
    got = {(r.a, r.b) for r in embedding_dedup.near_pairs(df).collect()}
    assert len(got & {(i, 18000 + i) for i in range(2000)}) >= 0.985 * 2000


def test_embedding_passes_follow_size():
    n = [embedding_dedup.passes(10**k, 64) for k in range(10)]
    assert n == sorted(n) and n[0] == embedding_dedup.LEAST_PASSES and n[4] < n[5] < n[6] < n[9]


def test_line_dedup_query(spark):
    import duckdb

    duckdb.sql(f"create or replace view documents as select * from '{DIR}/documents.parquet'")
    want = duckdb.sql(queries.ORACLE_SQL["op1_line_dedup"]).fetchall()
    got = queries.op1_line_dedup(spark, DIR).select("doc_id", "n_dropped", "text").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_line_dedup_cases(spark):
    rows = [(i, f"own {i}\n\n  Subscribe now \nend {i}", "s") for i in range(12)] + [(90, None, "s"), (91, "", None), (92, "Subscribe now", "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumnRenamed("doc_id", "line")
    got = {r["line"]: r for r in line_dedup.drop_lines(df).collect()}
    assert got[3].text == "own 3\n\nend 3" and got[3].n_dropped == 1
    assert got[90].text is None and got[91].text == "" and got[92].text == "Subscribe now"


def test_decontaminate(spark):
    item = "A train leaves Boston at 60 miles per hour and meets a second train after 3 hours near Albany today"
    items = spark.createDataFrame([(1, item), (2, None), (3, "too short")], "item_id long, text string")
    texts = [
        f"some words in front {item} and some behind",
        item.replace("60", "75").replace("Boston", "Denver").replace("3 hours", "4 hours"),
        item.replace("leaves", "quits").replace("meets", "sees").replace("near", "by"),
        "nothing of the kind stands in this text at all today", None, "",
    ]
    got = {r.doc_id: r for r in decontaminate.contaminations(docs_of(spark, texts), items).collect()}
    assert sorted(got) == [0, 1]
    assert not got[0].altered and got[1].altered


def test_decontaminate_copies_in_other_case(spark):
    item = "Each spring Élodie and Marta of Lyon pack 12 crates of pears for the Grand Market near Saint Étienne and Vienne"
    items = spark.createDataFrame([(1, item), (2, "Anna Berg sold Karl Lund seven old maps")], "item_id long, text string")
    texts = [item.upper(), item.lower(), f"and so it was that {item}", item, item.upper().replace("12", "15"), "we read that Anna Berg sold Karl Lund seven old maps", "EACH WORD OF THIS TEXT IS A CAPITAL ONE AND NONE OF IT IS OF ANY ITEM"]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminations(docs_of(spark, texts), items).collect()}
    assert sorted(got) == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 2)]
    assert [got[i, 1].altered for i in range(5)] == [False] * 4 + [True]
    n = len(item.split()) - decontaminate.WINDOW + 1
    assert all(got[i, 1].covered == 1 and got[i, 1].n_windows == n for i in range(5))


def test_chat_round_trip(spark):
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[TURN]", "[/ROLE]", "\\", "\\\\", " ", "a", "\n", "é"]
    r = random.Random(4)
    for _ in range(2000):
        turn = (r.choice(["user", "assistant", "system", "tool", "", "[INST]"]), "".join(r.choice(bits) for _ in range(r.randrange(7))))
        assert chat_format.parse(chat_format.render(*turn)) == [turn]
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (2, None, None, None), (2, 1, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {x.conv_id: x for x in chat_format.read_chats(chat_format.format_chats(df)).collect()}
    assert got[1].n_turns == 2 and got[1].loss_chars == len(rows[1][3])
    assert got[1].turns_sha256 == hashlib.sha256(b"user\nhi\nassistant\n</s>[INST] ok [/INST]\n").hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256(b"\n\nassistant\nx\n").hexdigest()


def test_pipeline_ends_with_ids_and_text(spark):
    import corpus_pipeline

    docs = docs_of(spark, ["some words of a text", "", None, *ODD])
    got = {r.doc_id: r for r in corpus_pipeline.encode_stage(spark, docs, DIR).collect()}
    digest = {r.doc_id: r for r in word_bpe.encode_digest(docs).collect()}
    plain = {r.doc_id: r for r in word_bpe.encode(docs).collect()}
    assert len(got) == len(ODD) + 3
    for i, r in got.items():
        assert (r.ids, r.decoded) == (plain[i].ids, plain[i].decoded)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (digest[i].n_tokens, digest[i].ids_sha256, digest[i].decoded_sha256)


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, DIR)
    assert 0 < out.count() <= 200 and "ids_sha256" in out.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard", "decontaminate", "bpe"]
