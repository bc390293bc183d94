"""Nulls, empty tables, repeated rows, clashing columns, very long words and texts, for every operator and stage."""

import hashlib
import random
import unicodedata

import numpy as np
import pytest

pytest.importorskip("kinetrail.llm")
import brute  # noqa: E402

from kinetrail.llm import chat_format, common, decontaminate, embedding_dedup, jaccard_join, language_id, line_dedup, queries, token_counts, toxicity, word_bpe  # noqa: E402

DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def bpe():
    return word_bpe.WordBPE(word_bpe.default_vocabulary())


@pytest.fixture(scope="module")
def unigram():
    return token_counts.UnigramCounter(token_counts.default_vocabulary())


def ids_of(bpe, texts):
    out = []
    for ids, at in bpe.batches(texts):
        out += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
    return out


def test_bpe_of_every_code_point(bpe):
    """Beside letters, beside a digit, doubled and beside a mark; of the large blocks of ideographs and syllables every seventh."""
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and (unicodedata.category(chr(c)) not in ("Cn", "Co") or c % 61 == 0)]
    points = [c for c in points if c % 7 == 0 or not (0x4E40 < c < 0x9F00 or 0xAC40 < c < 0xD700 or 0x20000 < c < 0x33000)]
    texts = [f"a{c}b {c}1 x{c}{c} !{c}" for c in map(chr, points)]
    by_library = word_bpe.LibraryBPE(word_bpe.default_vocabulary())
    for a in range(0, len(texts), 20_000):
        part = texts[a : a + 20_000]
        want = [e.ids for e in bpe.library.whole.encode_batch_fast(part, add_special_tokens=False)]
        assert ids_of(bpe, part) == want and ids_of(by_library, part) == want


def test_bpe_of_random_signs(bpe):
    by_library, r = word_bpe.LibraryBPE(word_bpe.default_vocabulary()), random.Random(3)
    texts = ["".join(r.choice("'s'll've !?aÀσΣ1² \n\x85ǅ́<|endoftext|>") for _ in range(r.randrange(30))) for _ in range(5000)]
    want = [e.ids for e in bpe.library.whole.encode_batch_fast(texts, add_special_tokens=False)]
    assert ids_of(bpe, texts) == want and ids_of(by_library, texts) == want


def test_bpe_of_long_words(bpe):
    r = random.Random(1)
    for letters in ("abcdefgh", "etaoinshr", "aA", "日本語中国人のはを", "abéüß", "x"):
        for n in (word_bpe.ROUND_BYTES - 1, word_bpe.ROUND_BYTES + 1, 5000):
            word = "".join(r.choice(letters) for _ in range(n))
            assert ids_of(bpe, [f"some {word} 's", word]) == [bpe.library.whole.encode(t, add_special_tokens=False).ids for t in (f"some {word} 's", word)]


def test_token_counts_of_long_words(unigram):
    r = random.Random(2)
    for letters in ("abcdef", "etaoinsr", "日本語ab", "x", "éßa🙂"):
        for n in (20, token_counts.WIDE + 1, 300):
            words = sorted({"▁" + "".join(r.choice(letters) for _ in range(n)) for _ in range(20)})
            assert unigram._trie(words).tolist() == [unigram._along(w) for w in words]
    assert unigram.count_texts(["x" * 50_000])[0][0] > 0


def viterbi(score, unknown, text):
    """The plain forward pass over a whole text, from the vocabulary itself."""
    word = "▁" + text.replace(" ", "▁")
    best = [(0.0, 0)]
    for e in range(1, len(word) + 1):
        top = (-np.inf, 0)
        for s in range(max(0, e - 16), e):
            x = score.get(word[s:e], unknown if e - s == 1 else None)
            if x is not None and best[s][0] + x > top[0]:
                top = best[s][0] + x, best[s][1] + (1 if word[s:e] in score else len(word[s].encode()))
        best.append(top)
    return best[-1][1]


def test_token_counts_of_a_whole_table(spark):
    """Against a forward pass over whole texts that shares nothing with the operator but the vocabulary file."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=token_counts.default_vocabulary())
    score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
    assert max(map(len, score)) == 16
    unknown = min(score.values()) - 10
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in queries.op4_token_counts(spark, DIR).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id] == (viterbi(score, unknown, r.text) if r.text else 0)


def test_jaccard_links_rows_without_an_id(spark):
    r = random.Random(5)
    base = [[f"w{r.randrange(500)}" for _ in range(60)] for _ in range(40)]
    rows = []
    for i, w in enumerate(base):
        near = w[:]
        near[-1] = "other"
        rows += [(i if i % 2 else None, " ".join(w)), (None if i % 3 else 100 + i, " ".join(near))]
    rows += [(None, rows[0][1])] * 3 + [(7, "a b"), (7, "c d e f g h"), (7, "a b")]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", __import__("pyspark").sql.functions.lit(1)))
    low = {}
    sets = [brute.shingles(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    label = brute.components(len(rows), links)
    for i, (d, _) in enumerate(rows):
        low[label[i]] = min(low.get(label[i], 10**9), d if d is not None else 10**9)
    key = lambda x: tuple(-1 if v is None else v for v in x)
    want = sorted(((d, len(sets[i]), low[label[i]] if low[label[i]] < 10**9 else None) for i, (d, _) in enumerate(rows)), key=key)
    assert sorted(map(tuple, got.collect()), key=key) == want


def test_jaccard_long_lists_are_split_before_they_travel():
    rng = np.random.default_rng(1)
    n = rng.integers(20, 60, 500).astype(np.int32)
    fp = rng.integers(1, 2**60, 500)
    key = np.where(np.arange(500) < 400, 7, np.arange(500)).astype(np.uint32)
    keep, rows = jaccard_join._long_here(np.zeros(500, np.int64), key, fp, n, 75, 4)
    assert (keep[400:] == 1).all() and 0 < (keep[:400] == 2).sum() <= 12
    assert set(rows["a"][rows["kind"] == 3]) == set(fp[:400])
    star = rows[rows["kind"] == 1]
    assert set(star["a"]) <= set(fp[:400][keep[:400] == 2]) and set(star["b"]) | set(star["a"]) == set(fp[:400])


def test_jaccard_blobs_round_trip():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    entries = jaccard_join._pack(jaccard_join._ENTRY, rng.integers(0, 99, 1000), rng.integers(0, 2**60, 1000), rng.integers(0, 99, 1000))
    bucket = rng.integers(0, 5_000_000, 1000)
    t = pa.Table.from_batches([jaccard_join._blobs(bucket, entries, 0)])
    assert sorted(t.column("bucket").to_pylist()) == sorted(set(bucket.tolist()))
    assert sorted(jaccard_join._entries(t, 0, jaccard_join._ENTRY).tolist()) == sorted(entries.tolist())
    assert len(jaccard_join._entries(t, 1, jaccard_join._SUBSET)) == 0


def plain_contaminations(rows, items):
    """(doc, item): n_windows, covered, altered, by lists of words."""
    import re

    def words(text):
        out, before = [], None
        for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
            raw = m[0]
            w = raw
            while len(w) > 1 and ord(w[0]) < 128 and not w[0].isalnum() and w[0].isprintable():
                w = w[1:]
            while len(w) > 1 and ord(w[-1]) < 128 and not w[-1].isalnum() and w[-1].isprintable():
                w = w[:-1]
            start = before is None or before[-1] in ".!?:;" or "\n" in text[gap : m.start()]
            low = w.lower()
            if any(c.isdigit() and c.isascii() for c in w) or low in decontaminate.NUMBERS:
                kind = decontaminate.NUMBER
            elif out and out[-1][0] == decontaminate.NUMBER and low in decontaminate.UNITS:
                kind = decontaminate.UNIT
            elif w[0].isupper() and not start:
                kind = decontaminate.NAME
            else:
                kind = decontaminate.LITERAL
            out.append((kind, low))
            before, gap = raw, m.end()
        return out

    def meet(x, y):
        """Whether two windows have one form, names as placeholders or as plain words."""
        for names in (True, False):
            kind = lambda w: decontaminate.LITERAL if w[0] == decontaminate.NAME and not names else w[0]
            if [kind(a) for a in x] == [kind(b) for b in y] and all(a[1] == b[1] for a, b in zip(x, y) if kind(a) == 0) and sum(kind(a) == 0 for a in x) >= min(decontaminate.LITERALS, len(x)):
                return [(kind(a), a[1], b[1]) for a, b in zip(x, y) if kind(a)]
        return None

    out = {}
    for d, text in rows:
        for item, question in items:
            x, y = words(question or ""), words(text or "")
            size = min(len(x), decontaminate.WINDOW)
            if len(x) < decontaminate.SHORTEST:
                continue
            lines = {}
            for p in range(len(x) - size + 1):
                for a in range(len(y) - size + 1):
                    slots = meet(x[p : p + size], y[a : a + size])
                    if slots is not None:
                        lines.setdefault(a - p, []).append((p, slots))
            places, n = {}, 0
            for windows in lines.values():
                pairs = {s for _, w in windows for s in w}
                sound = len({(k, v) for k, v, _ in pairs}) == len(pairs) == len({(k, w) for k, _, w in pairs})
                for p, w in windows:
                    altered = any(v != u for _, v, u in w)
                    if sound or not altered:
                        n += 1
                        places[p] = places.get(p, False) or altered
            covered = len({q for p in places for q in range(p, p + size)}) / max(len(x), 1)
            if places and covered >= decontaminate.COVER:
                out[d, item] = (n, covered, any(places.values()))
    return out


def test_decontaminate_equals_plain_version(spark):
    r = random.Random(8)
    vocab = "the a of train leaves town meets river bridge under costs apples sold near Boston Albany Denver Vienna 3 14 60 75 miles hours kg seven".split()
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([4, 6, 8, 14, 30])))) for i in range(40)]
    rows = []
    for i in range(160):
        q = items[r.randrange(40)][1].split()
        swap = {"Boston": "Denver", "60": "75"} if i % 3 == 0 else {}
        q = [swap.get(w, w) if r.random() < (1 if i % 2 else 0.6) else w for w in q]
        if i % 7 == 0:
            q = [w.upper() for w in q]
        rows.append((i, " ".join(r.choice(vocab) for _ in range(6)) + r.choice([" ", "\n", ". "]) + " ".join(q) + " " + " ".join(r.choice(vocab) for _ in range(5))))
    rows += [(900, None), (901, ""), (None, items[5][1] + " " + items[30][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id as h", "text as slots")
    got = {(x.doc_id, x.item_id): (x.n_windows, x.covered, x.altered) for x in decontaminate.contaminations(df, spark.createDataFrame([*items, (99, None)], "item_id long, text string")).collect()}
    assert got == plain_contaminations(rows, items)
    assert len(got) > 60 and any(x[2] for x in got.values())


def test_decontaminate_one_mapping_for_each_alignment(spark):
    item = "A train leaves Boston at 60 miles per hour and another train returns to Boston at 60 miles per hour today"
    half = item.replace("Boston", "Denver", 1).replace("60", "75", 1)
    df = spark.createDataFrame([(1, half), (2, item.replace("Boston", "Denver").replace("60", "75"))], "doc_id long, text string")
    got = {x.doc_id: x for x in decontaminate.contaminations(df, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert got[2].altered and got[2].covered == 1
    assert 1 not in got or (not got[1].altered and got[1].covered < 1)


def test_decontaminate_by_bit_table(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(tuple, decontaminate.contaminations(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "SENT_MOST", 0)
    assert sorted(map(tuple, decontaminate.contaminations(docs, items).collect())) == want and want


def test_line_dedup_of_clashing_columns(spark):
    rows = [(i, f"own {i}\nsame", "s") for i in range(12)]
    df = spark.createDataFrame(rows, "page long, text string, source string").selectExpr("*", "1 as own_site", "2 as GONE_LINES", "3 as n_dropped", "4 as `a.b`")
    got = line_dedup.drop_lines(df)
    assert got.columns == ["page", "text", "source", "own_site", "GONE_LINES", "a.b", "n_dropped"]
    assert {(r["text"], r["own_site"], r["GONE_LINES"], r["a.b"], r["n_dropped"]) for r in got.collect()} == {(f"own {i}", 1, 2, 4, 1) for i in range(12)}


def test_host_of(spark):
    urls = ["https://User:pw@Example.ORG:8080/a?b#c", "http://a.b", "ftp://h/x@y", "no url", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(line_dedup.host_of("url").alias("h"))
    assert [r.h for r in df.collect()] == ["example.org", "a.b", "h", "", "", None]


def test_page_lines_query(spark):
    import duckdb

    duckdb.sql(f"create or replace view pages as select * from '{DIR}/pages.parquet'")
    got = sorted(map(tuple, queries.op1_page_lines(spark, DIR).select("page_id", "host", "n_dropped", "text").collect()))
    assert got == sorted(duckdb.sql(queries.ORACLE_SQL["op1_page_lines"]).fetchall()) and got


def test_page_text_and_lines_of_a_host(spark):
    rows = [(i, f"https://A.example/{i}", f"<nav><a>Home</a></nav><SCRIPT>x</p></SCRIPT><!-- <p> --><p>own <b>text</b> {i}<br/>more {i}</p><footer>the end</footer>") for i in range(20)] + [(90, "https://b.example", "<p>Home</p>"), (91, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").select("page_id", line_dedup.host_of("url").alias("host"), line_dedup.page_text("html").alias("text"))
    got = {r.page_id: (r.n_dropped, r.text) for r in line_dedup.drop_lines(df, "host").collect()}
    assert got[3] == (2, "own text 3\nmore 3\n") and got[90] == (0, "Home\n") and got[91] == (0, None)


@pytest.mark.parametrize("name, table", [("op2_ngram_jaccard", "documents"), ("op8_embedding_dedup", "embeddings"), ("op10_chat_format", "conversations")])
def test_query_equals_its_sql(spark, name, table):
    import duckdb

    duckdb.sql(f"create or replace view {table} as select * from '{DIR}/{table}.parquet'")
    res = duckdb.sql(queries.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, DIR).select(*res.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(res.fetchall(), key=repr)


def test_language_parts_come_from_all_over(spark):
    text = "".join(f"{i:05d} " for i in range(2000))
    rows = language_id.sample(spark.createDataFrame([(4, text, "en", "a", 1), (8, "short", "en", "a", 1)], DOC).where("crc32(cast(doc_id as string)) % 4 <> 2"))
    parts = {len(r.parts): r.parts for r in rows}
    assert parts[1] == ["short"]
    at = [text.index(p) for p in parts[language_id.PARTS]]
    assert at == sorted(at) and at[0] < len(text) / 4 and at[-1] >= len(text) * 3 / 4 - language_id.PART_CHARS and all(len(p) == language_id.PART_CHARS for p in parts[language_id.PARTS])


def test_many_languages(spark):
    rows = [(4 * i, f"{'abcdefghijklmnopqrst'[i % 20] * 30} text {i}", f"l{i % 200}", "a", 9) for i in range(1200)]
    got = language_id.language_id(spark.createDataFrame(rows, DOC))
    assert got.count() == 1200 and {r.lang_pred for r in got.collect()} <= {f"l{i}" for i in range(200)}


def test_empty_tables_and_clashing_columns(spark):
    empty = spark.createDataFrame([], DOC + ", h long, rid long, _gone string")
    assert line_dedup.drop_lines(empty).count() == 0
    assert decontaminate.contaminations(empty, spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert token_counts.token_counts(empty).count() == 0
    assert language_id.language_id(empty).count() == 0
    assert word_bpe.encode(empty, digests=True).count() == 0 and word_bpe.encode_digest(empty).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(empty, labels) is None and toxicity.toxicity(empty, None).count() == 0
    assert embedding_dedup.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, low int")).count() == 0
    talk = spark.createDataFrame([], "conv_id long, turn int, role string, text string, formatted string")
    assert chat_format.read_chats(chat_format.format_chats(talk)).count() == 0


def test_embedding_group_wider_than_windows(spark):
    """One group of copies with small changes, far more than a window holds, and clashing columns."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal(32) + 0.05 * rng.standard_normal((6000, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(None, x[0].tolist()), (3, x[3].tolist())], "vec_id long, embedding array<double>").selectExpr("*", "vec_id as rid", "1 as low", "2 as sound", "3 as copies")
    got = embedding_dedup.embedding_dedup(df).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (u @ u.T >= 0.9).sum(axis=1) - 1 + (u @ u[3] >= 0.9)
    assert sorted(r.vec_id for r in got if r.vec_id is not None) == sorted([*range(6000), 3])
    assert all(r.n_links == (want[r.vec_id] if r.vec_id is not None else 0) for r in got)
    assert {r.component_id for r in got} == {0, None}


def test_rounded_vectors_bound_the_cosine():
    import pyarrow as pa

    rng = np.random.default_rng(9)
    x = rng.standard_normal((400, 48)) ** 3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y, off = embedding_dedup._restored(pa.array([r.tobytes() for r in embedding_dedup.rounded(x)], pa.binary()).slice(0, 400), 48)
    sure, maybe = embedding_dedup._judge(y @ y.T, off[:, None], off, 48)
    true = x @ x.T >= 0.9
    assert (maybe >= true).all() and (true >= sure).all() and sure.sum() >= 400


def test_forest_keeps_groups():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 200, 300), rng.integers(0, 200, 300)
    sure = rng.random(300) < 0.5
    x, y, s = embedding_dedup._forest(a, b, sure)
    assert brute.components(200, zip(a[sure], b[sure])) == brute.components(200, zip(x[s].tolist(), y[s].tolist()))
    assert brute.components(200, zip(a, b)) == brute.components(200, zip(x.tolist(), y.tolist()))


def test_chat_digests_equal_plain_version(spark):
    r = random.Random(3)
    bits = ["<s>", "</s>", "[OUT]", "[/OUT]", "[INST]", "\\", " ", "a", "\n", "é", "🙂"]
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool"]), "".join(r.choice(bits) for _ in range(r.randrange(9)))) for c in range(30) for t in range(r.randrange(1, 9))]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (40, 1, "user", None), (40, 0, None, "z"), (41, 0, "user", "same"), (41, 0, "user", "same")]
    shuffled = rows[:]
    r.shuffle(shuffled)
    formatted = chat_format.format_chats(spark.createDataFrame(shuffled, "conv_id long, turn long, role string, text string").selectExpr("*", "'clash' as formatted", "1 as place"))
    got = {x.conv_id: x for x in chat_format.read_chats(formatted).collect()}
    written = {}
    for x in formatted.collect():
        written[x.conv_id] = written.get(x.conv_id, 0) + len(x.formatted)
    assert set(got) == {c for c, *_ in rows}
    for c, g in got.items():
        mine = [(role or "", text or "") for k, _, role, text in sorted((x for x in rows if x[0] == c), key=lambda x: x[1])]
        learned = "".join(t for role, t in mine if role == "assistant")
        assert (g.n_turns, g.loss_chars, g.formatted_chars) == (len(mine), len(learned), written[c])
        assert g.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()


def test_chat_reader_refuses_what_it_cannot_parse(spark):
    bad = spark.createDataFrame([(1, 0, "user", "<s>[INST] x", None, None)], "conv_id long, turn long, role string, formatted string, loss_from long, loss_to long")
    with pytest.raises(Exception, match="not of the grammar"):
        chat_format.read_chats(bad).collect()


def test_token_files_of_several_parts(spark):
    """Prefix sums over parts, in the order of ids, with null and repeated ids."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").repartition(7)
    docs = docs.union(spark.createDataFrame([(None, "no id"), (3, "again"), (10**9, "")], "doc_id long, text string"))
    folder = f"{common.shared_folder(spark)}/parts-test"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        manifest = word_bpe.write_token_files(docs, folder)
        got = sorted(word_bpe.read_token_files(spark, manifest).collect(), key=lambda r: r.start)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(manifest) > 1 and [p["base"] for p in manifest] == np.concatenate(([0], np.cumsum([p["n_tokens"] for p in manifest])))[:-1].tolist()
    assert [r.doc_id for r in got] == [None, *sorted(r.doc_id for r in got[1:])] and len(got) == docs.count()
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    n = {r.doc_id: r.n_tokens for r in word_bpe.encode_digest(docs.where("doc_id <> 3")).collect()}
    assert all(r.n_tokens == n[r.doc_id] + 1 for r in got if r.doc_id not in (None, 3))


def test_token_files_in_folders_of_any_form(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    for folder in (str(tmp_path / "bare"), f"file:{tmp_path}/one", f"file://{tmp_path}/two"):
        manifest = word_bpe.write_token_files(docs, folder)
        assert manifest[0]["uri"].startswith("file:/") and word_bpe.read_token_files(spark, manifest).count() == 2
    with pytest.raises(ValueError):
        word_bpe._store("/no/scheme")


def test_bare_words():
    text = np.frombuffer(b"(ab) ... x!! -y-", np.uint8)
    start, end, _ = common.words(text, np.array([0, len(text)]))
    a, b = common.bare(text, start, end, toxicity._PUNCT)
    assert [text[i:j].tobytes() for i, j in zip(a, b)] == [b"ab", b".", b"x", b"y"]


# ---- the pipeline --------------------------------------------------------------------------


def stage_docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], DOC).selectExpr("*", "'x' as th", "1 as _gone", "2 as leak", "3 as _id")


def test_pipeline_near_copies_leave_one_row(spark):
    import corpus_pipeline

    r = random.Random(6)
    w = [" ".join(r.choice("abcdefgh") + str(r.randrange(50)) for _ in range(40)) for _ in range(4)]
    rows = [(1, w[0]), (2, w[0]), (3, w[0] + " tail"), (4, w[1]), (4, w[1]), (4, w[2]), (None, w[3]), (None, w[3]), (None, w[1] + " end"), (6, ""), (7, None), (None, "")]
    got = corpus_pipeline.near_copy_stage(spark, stage_docs(spark, rows), DIR)
    assert got.columns == corpus_pipeline.COLUMNS
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    assert sorted(((x.doc_id, x.text) for x in got.collect()), key=key) == sorted([(1, w[0]), (4, w[1]), (4, w[2]), (None, w[3]), (6, ""), (7, None), (None, "")], key=key)


def test_pipeline_benchmark_stage_by_text(spark):
    import corpus_pipeline

    items = spark.read.parquet(f"{DIR}/benchmark.parquet")
    long = max((r.text for r in items.collect() if r.text), key=len)
    rows = [(1, f"before {long} behind"), (None, long), (2, "clean text of its own"), (2, long), (3, None), (None, "")]
    got = corpus_pipeline.benchmark_stage(spark, stage_docs(spark, rows), DIR)
    assert sorted(((x.doc_id, x.text) for x in got.collect()), key=str) == sorted([(2, "clean text of its own"), (3, None), (None, "")], key=str)


def test_pipeline_line_stage(spark):
    import corpus_pipeline

    rows = [(i, f"own {i}\nsame") for i in range(12)] + [(None, None), (50, "")]
    got = {x.doc_id: (x.text, x.n_chars) for x in corpus_pipeline.line_stage(spark, stage_docs(spark, rows), DIR).collect()}
    assert got[3] == ("own 3", 5) and got[None] == (None, 0) and got[50] == ("", 0)


def test_pipeline_language_stage_and_empty_table(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, "x", 0), (10**6 + 1, "12 345 !", None, "x", 3), (None, "the words of this text are plain", None, None, None)], DOC)
    got = corpus_pipeline.language_stage(spark, docs.union(odd).withColumn("lang_pred", docs.lang), DIR)
    kept = [r.doc_id for r in got.select("doc_id").collect()]
    assert got.columns == corpus_pipeline.COLUMNS and None in kept and 10**6 not in kept and 10**6 + 1 not in kept
    with_letters = docs.where("regexp_like(text, '[A-Za-z]')").count()
    assert len(kept) >= 0.99 * with_letters
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, DIR)
        assert empty.count() == 0


def test_toxicity_learns_without_the_texts_in_the_driver(spark):
    """60 texts of 16,000 words: their word hashes alone are 23 MB, the network's tables 6 MB."""
    import tracemalloc

    rows = [(i, " ".join(f"w{(i * 31 + j * 7) % 5000}" for j in range(16000)) + " vile" * (i % 2)) for i in range(80)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    tracemalloc.start()
    try:
        net = toxicity.fit(docs, labels)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert net.languages == ["en"] and most < 30e6, most


def test_toxicity_with_labels_of_one_kind_or_few(spark):
    docs = spark.createDataFrame([(i, "vile scum" if i % 2 else "kind folk", "en") for i in range(40)], "doc_id long, text string, lang string")
    one = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, toxic int")
    few = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert toxicity.fit(docs, one) is None
    rows = toxicity.toxicity(docs, toxicity.fit(docs, few)).collect()
    assert all(r.predicted == r.doc_id % 2 for r in rows)
