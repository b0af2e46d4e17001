"""The text operators against brute force, on odd rows and on whole small tables."""

import base64
import hashlib
import html
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

tokenizers = pytest.importorskip("tokenizers")

from marlstone.llm.archives import archive  # noqa: E402
from marlstone.llm.bit_slices import Block, packed, search, unpacked  # noqa: E402
from marlstone.llm.catalog import QUERIES, vocabulary  # noqa: E402
from marlstone.llm.common import new_path, ship  # noqa: E402
from marlstone.llm.credentials import redact, scan  # noqa: E402
from marlstone.llm.decontaminate import clean, leaks  # noqa: E402
from marlstone.llm.part_enum import groups, keep_one  # noqa: E402
from marlstone.llm.templates import main_text  # noqa: E402
from marlstone.llm.token_files import SequenceFile, token_files, write_shards  # noqa: E402
from marlstone.llm.toxicity import Network, Scorer, sample, score, toxicity, train, words_of  # noqa: E402
from marlstone.llm.trie_bpe import TrieBpe, encode_decode  # noqa: E402
from marlstone.llm.url_rules import judge  # noqa: E402
from tests.compare import connect, differences  # noqa: E402

DOCS = "doc_id long, text string, n_tokens long, row string, seed string"
ODD = [None, "", " ", "a  b", " x\n\ny \n", "don't <|endoftext|> stop", "日本語 🙂🙂 \t", "=" * 3000, "word " * 20000, "\x1c \x85"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 7, "clash", "clash") for i, t in zip(ids, texts, strict=True)], DOCS).repartition(3)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary())


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_trie_agrees_with_library(library):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab c\n\t'sé😀 1.=Â　<|endoftext|>") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    bpe = TrieBpe(vocabulary())
    for text, ids in zip(texts, bpe.encode_pieces(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert bpe.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_encode_decode_odd_rows(spark, library):
    docs = documents(spark, [*ODD, "same", "same"], [*range(len(ODD) - 1), None, 5, 5])
    found = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_decode(docs, vocabulary()).collect())
    expected = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id or -1, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    assert found == sorted(expected)


def test_token_files_odd_rows(spark, library):
    docs = documents(spark, ODD)
    found = sorted(token_files(docs, vocabulary(), length=64, rows=2).collect())
    start = 0
    for r, text in zip(found, ODD, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files_random_access(spark):
    folder = new_path(spark, "tokens")
    manifest = write_shards(documents(spark, ODD), vocabulary(), folder, length=64, rows=2).collect()
    for shard in manifest:
        file = SequenceFile(folder, shard.ids_file)
        masks = np.concatenate([file.mask(i).to_numpy(zero_copy_only=False) for i in range(len(file))])
        assert all(len(file.ids(i)) == 64 for i in range(len(file)))
        assert masks.sum() == shard.n_ids and masks[: shard.n_ids].all()
        with pytest.raises(IndexError):
            file.ids(len(file))


def test_top_k_block_against_products():
    rng = np.random.default_rng(1)
    values = rng.integers(-600, 600, (700, 16))
    values[100:300] = values[5]
    ids = rng.permutation(700)
    block = Block(ids, values)
    for i in (0, 5, 150, 699):
        found, scores = block.top(int(ids[i]), values[i], 10)
        product = values @ values[i]
        order = [j for j in np.lexsort((ids, -product)) if ids[j] != ids[i]][:10]
        assert found.tolist() == ids[order].tolist() and scores.tolist() == product[order].tolist()


def test_search_odd_rows(spark):
    rows = [(0, [0.5, 0.25]), (1, [0.5, 0.25]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [1.0]), (None, [1.0, 1.0]), (6, [-0.5, 0.0]), (7, [])]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    found = [tuple(r) for r in search(vectors, vectors.filter("vec_id = 0"), 10).orderBy("rank").collect()]
    assert found == [(0, 1, 1, 512 * 512 + 256 * 256), (0, 2, 6, -512 * 512)]


def test_search_broadcasts_no_queries(spark):
    """Queries sent to every group of row blocks were collected by the driver: their size times the number of groups."""
    rng = random.Random(3)
    rows = [(i // 2 if i % 9 == 0 else i, [rng.randint(-500, 500) / 1024 for _ in range(3 if i % 5 else 2)]) for i in range(200)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = search(vectors, vectors.filter("vec_id % 7 = 0"), 4, rows=16, query_rows=4)
    asked, best = {}, []
    for i, x in rows:
        if i % 7 == 0:
            asked[i] = min(asked.get(i, x), x)
    for i, x in asked.items():
        scores = [(-sum(round(a * 1024) * round(b * 1024) for a, b in zip(x, y, strict=True)), j) for j, y in rows if j != i and len(y) == len(x)]
        best += [(i, rank, j, -score) for rank, (score, j) in enumerate(sorted(scores)[:4], 1)]
    assert sorted(map(tuple, found.collect())) == sorted(best)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    none = vectors.limit(0)
    assert search(none, vectors).isEmpty() and search(vectors, none).isEmpty()


def test_blocks_keep_values_of_any_width():
    for most in (0, 32767, 32768, 2**31 - 1, 2**31, 2**62):
        for values in (np.array([[most, -1], [-most - 1, 0]], np.int64), np.zeros((3, 0), np.int64)):
            again = unpacked(packed(values), *values.shape)
            assert again.dtype == np.int64 and again.tolist() == values.tolist()
    assert len(packed(np.array([[500, -500]]))) == 4


def test_search_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.001"
    query = QUERIES["op2_bit_slices"]
    with connect(folder) as connection:
        found = query.build(spark, folder)
        assert differences(found, connection, query.sql) is None or sorted(map(tuple, found.collect())) == sorted(connection.execute(query.sql).fetchall())


BASE = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "(AKIA[A-Z0-9]+)", 1, 20),
    ("hex", "([0-9a-f]+)", 1, 24),
]


def base_spans(text):
    found = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        for m in re.finditer(pattern, text, re.I | re.A if kind == "assign" else 0):
            if len(m[group]) >= least:
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for *_, s in sorted(found))


def test_secrets_against_patterns(spark):
    rng = random.Random(5)
    parts = ["token=", "secret: ", "PassWord = '", "AKIA", "ABCDEF0123456789ZZ", "0123456789abcdef" * 2, "é🙂", " ", "api_key:", "x" * 5, "=", "token", ":abcdefgh", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None, "", "token=abcdefg " * 500]
    docs = documents(spark, texts)
    found = {r.doc_id: r for r in scan(docs).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        spans = base_spans(text or "")
        assert found[i].base_sha256 == sha(spans.encode())
        assert set(filter(None, spans.split(","))) <= set(found[i].spans.split(","))
        assert found[i].n_hex == spans.count("hex:")


def test_a_frequent_url_of_many_tokens_is_mined_as_one(spark):
    many = "/".join(f"part{c}" for c in "abcdefghijklmnopqrst")
    urls = [f"http://a.net/{many}"] * 30 + [f"http://b.org/fr/story{c}" for c in "abcdefghij" * 3]
    urls += ["http://c.com/partg", "http://c.com/fr", "http://c.com/new", "http://c.com/fr/partg"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    found = {r.page_id: (r.verdict, r.source) for r in judge(pages).collect()}
    # Of two rules as sure and as frequent, the verdict later in the alphabet.
    assert [found[i] for i in range(60, 64)] == [("block", "mined"), ("allow", "mined"), ("allow", "default"), ("block", "mined")]


def test_a_weak_secret_may_begin_with_many_letters(spark):
    long = "k" * 50 + "7x"
    docs = documents(spark, [f"ASIAABCDEFGHIJKLMNOP {long}", f"ASIAABCDEFGHIJKLMNOP {'k' * 60}", f"ASIAABCDEFGHIJKLMNOP {'k' * 100_000}7"])
    assert [r.spans for r in scan(docs).orderBy("doc_id").collect()] == ["weak_id:0:20,weak_secret:21:73", "", "weak_id:0:20,weak_secret:21:100022"]


def test_weak_secrets_need_their_complements(spark):
    secret = "wJalrXUtnFEMIK7MDENGbPxRfiCYzz9EXAMPLEKEY"
    texts = [f"ASIAABCDEFGHIJKLMNOP and {secret}", "ASIAABCDEFGHIJKLMNOP alone", f"{secret} alone", f"ASIAABCDEFGHIJKLMNOP {'far ' * 200}{secret}", f"https://api.example.com ASIAABCDEFGHIJKLMNOP {secret}"]
    found = [r.spans for r in scan(documents(spark, texts)).orderBy("doc_id").collect()]
    assert found[0] == f"weak_id:0:20,weak_secret:25:{25 + len(secret)}"
    assert found[1:4] == ["", "", ""]
    assert found[4].startswith("endpoint:0:23,weak_id:24:44,weak_secret:45")


def test_weak_parts_that_overlap_base_ones(spark):
    hexed, secret = "5f4dcc3b5aa765d61d8327deb882cf99", "wJalrXUtnFEMIK7MDENGbPxRfiCYzz9EXAMPLEKEY"
    texts = [
        f"client_id={hexed}\nkey {secret}",
        f"client_id={hexed} alone",
        "https://a.example.com/?id=ASIAABCDEFGHIJKLMNOP&token=abcdefgh",
        f"ASIAABCDEFGHIJKLMNOP Zz9/{hexed}/Zz9",
        f"token={secret} ASIAABCDEFGHIJKLMNOP",
    ]
    found = [r.spans for r in scan(documents(spark, texts)).orderBy("doc_id").collect()]
    assert found[0] == f"weak_id:0:42,hex:10:42,weak_secret:47:{47 + len(secret)}"
    assert found[1] == "hex:10:42"
    assert found[2] == f"endpoint:0:{len(texts[2])},weak_id:26:46,assign:47:61"
    assert found[3] == "weak_id:0:20,weak_secret:21:61,hex:25:57"
    assert found[4] == "assign:0:47,weak_id:48:68"
    redacted = [r.text for r in redact(documents(spark, texts)).orderBy("doc_id").collect()]
    assert redacted == ["[SECRET]\nkey [SECRET]", "client_id=[SECRET] alone", "[SECRET]", "[SECRET] [SECRET]", "[SECRET] [SECRET]"]


def test_redaction(spark):
    docs = spark.createDataFrame([(1, 'a token = "0123456789abcdef0123456789" b', 9), (2, "plain", 5), (None, None, None)], "doc_id long, text string, n_chars long")
    found = {r.doc_id: r for r in redact(docs).collect()}
    assert found[1].text == 'a [SECRET]" b' and found[1].n_chars == len(found[1].text)
    assert found[2].text == "plain" and found[None].text is None


def test_url_rules(spark):
    urls = ["http://a.example.net/en/1", "https://EXAMPLE.com/de/x?q=1", "http://b.net/x", "ftp://x.org/fr/", "http://a.net", None, "no scheme", "http://com/en/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    found = [(r.host, r.path, r.rule, r.verdict) for r in judge(pages).orderBy("page_id").collect()]
    assert found[:5] == [("a.example.net", "/en/1", "example.net/en/", "allow"), ("example.com", "/de/x", "example.com/de/", "block"), ("b.net", "/x", "net/", "block"), ("x.org", "/fr/", "org/fr/", "allow"), ("a.net", "", None, found[4][3])]
    assert found[5][:3] == ("", "", None) and found[6][:3] == ("", "", None)
    assert all(f[3] in ("allow", "block") for f in found)
    assert judge(pages.limit(0)).count() == 0


def test_main_text(spark):
    page = "<html><body><nav><ul><li>menu</li></ul></nav><div class=ad>buy</div><article><h1>T &amp; x</h1><p>one<br>two<p>three <b>bold</b></p><div class='comments'>no</div></article><footer>f</footer>"
    rows = [(i, f"http://h/{i}", page.replace("three", f"three{i}"), "x") for i in range(6)] + [(6, None, None, "x"), (7, "u", "", "x"), (8, "u", "a < b", "x")]
    found = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()}
    assert found[2] == "T & x\none two\nthree2 bold"
    assert (found[6], found[7], found[8]) == ("", "", "a < b")


def test_main_text_without_repeated_blocks(spark):
    site = "<div class=x7><p>All rights stay with the editors of this site</p></div>"
    own = [f"{w} has a long story of its own that no other page of the host tells, " * 2 for w in "abcdefgh"]
    page = "<body><article><h1>{}</h1><div class=x1>Our daily letter</div><p>{}</p>{}</article></body>"
    rows = [(i, f"http://a/{i}", page.format(i, text, site)) for i, text in enumerate(own)]
    rows += [(100 + i, f"http://copies/{i}", page.format(0, own[0], site)) for i in range(8)]
    rows += [(200 + i, f"http://few/{i}", page.format(i, own[i], site)) for i in range(3)]
    found = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    tail = "All rights stay with the editors of this site"
    for i, text in enumerate(own):
        assert found[i] == f"{i}\n{text.strip()}"
        assert found[100 + i] == f"0\nOur daily letter\n{own[0].strip()}\n{tail}"
    assert found[201] == f"1\nOur daily letter\n{own[1].strip()}\n{tail}"


def test_main_text_inside_marked_wrappers(spark):
    whole = "the whole article " * 9
    article = f"<article><h1>T</h1><p>{whole}</p></article>"
    wrapped = [
        f"<div class=\"site-content no-sidebar\">{article}</div><p>copyright</p>",
        f"<div class=\"page has-sidebar\"><div class=sidebar>side</div>{article}</div>",
        f"<div id=social-post><main>{article}</main></div>",
        f"<form><nav>menu</nav>{article}</form>",
        f"<div class=notice><h1>T</h1><p>{whole}</p></div>",
        f"<div><button>go</div>{article}<button>x</button>",
        f"<div><p><select><option>a</p></div>{article}<aside><article>teaser</article></aside>",
        f"<div><svg><path/></div>{article}<div class=comments><article>a comment</article></div>",
        f"<body><canvas>{article}<p><video>none</video></p></body>",
    ]
    rows = [(i, f"http://h{i}/", page) for i, page in enumerate(wrapped)]
    found = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {i: f"T\n{whole.strip()}" for i in range(len(wrapped))}


def test_main_text_of_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in QUERIES["op6_page_templates"].build(spark, folder).collect():
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        lines = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n".join(filter(None, lines)) and r.n_chars == len(r.text)


def sets_of(texts, n):
    out = []
    for t in texts:
        w = t.encode().lower().split() if t else []
        k = min(n, len(w))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    return out


def components_by_force(texts, n, percent):
    sets, at = sets_of(texts, n), list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((at[i], at[j]))
                at = [low if x == high else x for x in at]
    return at, list(map(len, sets))


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (1, 60)])
def test_groups_against_all_pairs(spark, n, percent):
    rng = random.Random(n)
    texts = []
    for _ in range(25):
        words = [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) for _ in range(rng.randint(1, 90))]
        for _ in range(rng.randint(1, 9)):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = "edit"
            texts.append(" ".join(copy).upper() if rng.random() < 0.3 else "\t".join(copy))
    texts += [None, "", " ", "one", "ONE", "one two", "x " * 30000, "x " * 20000]
    expected, sizes = components_by_force(texts, n, percent)
    found = sorted((r.doc_id, r.component_id, r.n_shingles) for r in groups(documents(spark, texts), n, percent).collect())
    assert found == [(i, c, s) for i, (c, s) in enumerate(zip(expected, sizes, strict=True))]


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 30)])
def test_groups_of_long_texts(spark, n, percent):
    rng, texts = random.Random(percent), []
    for size in (900, 1100, 2000, 2150, 4000, 4300, 9000):
        words = [f"w{rng.randrange(50000)}" for _ in range(size)]
        for edits in (0, 0, 0.002, 0.005, 0.01, 0.02, 0.05):
            copy = list(words)
            for at in rng.sample(range(size), int(edits * size)):
                copy[at] = f"w{rng.randrange(50000)}"
            texts.append(" ".join(copy[: int(size * rng.choice([1, 0.95, 0.86, 0.84, 0.81, 0.79, 0.4]))]))
    expected, sizes = components_by_force(texts, n, percent)
    assert len(set(expected)) < len(texts) - 7
    found = sorted((r.doc_id, r.component_id, r.n_shingles) for r in groups(documents(spark, texts), n, percent).collect())
    assert found == [(i, c, s) for i, (c, s) in enumerate(zip(expected, sizes, strict=True))]


def test_keep_one(spark):
    docs = documents(spark, ["a b c d e f"] * 3 + ["", None, "other words are here now"], [4, 2, 2, 7, None, 9])
    found = keep_one(docs)
    assert found.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in found.collect()) == sorted([(2, "a b c d e f"), (7, ""), (-1, None), (9, "other words are here now")], key=lambda x: x[0])


def test_groups_of_empty_table(spark):
    assert groups(documents(spark, []).limit(0)).count() == 0


def leaks_by_force(doc, item, least=5):
    a, b = (re.findall(r"[^\W_]+", (t or "").lower()) for t in (doc, item))
    window = min(13, len(b))
    substitutions = 2 * window // 13
    return len(b) >= least and any(
        sum(x == y for x, y in zip(a[i : i + window], b[j : j + window], strict=False)) >= window - substitutions
        for i in range(len(a) - window + 1)
        for j in range(len(b) - window + 1)
    )


def test_leaks_against_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [" ".join(word() for _ in range(n)) for n in (4, 5, 6, 7, 8, 11, 12, 13, 14, 17, 23, 30)] + [None, ""]
    texts = []
    for _ in range(160):
        words = rng.choice(items[:12]).split()
        for _ in range(rng.randint(0, 1 + len(words) // 5)):
            words[rng.randrange(len(words))] = word()
        first = rng.choice([0, 0, rng.randint(0, 8)])
        texts.append(" ".join([*(word() for _ in range(rng.randint(0, 20))), *words[first:], *(word() for _ in range(5))]) + ".")
    texts += [None, "", "short text"]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id long, text string, seed long")
    docs = documents(spark, texts)
    expected = {(d, i) for d, t in enumerate(texts) for i, x in enumerate(items) if leaks_by_force(t, x)}
    assert {(r.doc_id, r.item_id) for r in leaks(docs, benchmark).collect()} == expected
    assert expected and {r.doc_id for r in clean(docs, benchmark).collect()} == set(range(len(texts))) - {d for d, _ in expected}


def test_leaks_of_short_and_unspaced_items(spark):
    items = ["What is the capital?", "日本の首都はどこですか", "これは十三文字より長い問題の文章です", "บ้านนี้", "what is"]
    texts = ["so: what is, THE capital! And what is the capital", "what was the capital", "前文。日本の首都はどこですか。", "あのこれは十三文字より永い問題の文章ですよ", "ดูบ้านนี้สิ", "is", None]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = documents(spark, [*texts, texts[2]], [*range(7), 2])
    found = sorted((r.doc_id, r.item_id, r.matched, r.doc_word) for r in leaks(docs, benchmark, least=1).collect())
    assert [f[:2] for f in found] == [(0, 0), (0, 4), (2, 1), (2, 1), (3, 2), (4, 3)]
    assert found[0][2:] == (4, 6) and found[2][2:] == (11, 2)
    assert sorted(r.doc_id for r in clean(docs, benchmark, least=1).collect()) == [1, 5, 6]
    # By default a few common words are no passage.
    assert sorted(r.doc_id for r in clean(docs, benchmark).collect()) == [0, 1, 4, 5, 6]


def test_one_substitution_costs_no_item_of_seven_words_or_more(spark):
    items = {n: [f"w{n}x{i}" for i in range(n)] for n in range(5, 15)}
    changed = [(n, " ".join(["before", *item[:i], "other", *item[i + 1 :], "after"])) for n, item in items.items() for i in range(n)]
    benchmark = spark.createDataFrame([*((n, " ".join(item)) for n, item in items.items()), (2, "Yes")], "item_id long, text string")
    found = leaks(documents(spark, [*(text for _, text in changed), "yes"]), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(d, n) for d, (n, _) in enumerate(changed) if n >= 7} and len(found) == sum(range(7, 15))


def test_leaks_of_empty_tables_and_long_texts(spark):
    item = " ".join(f"w{i}" for i in range(20))
    benchmark, docs = spark.createDataFrame([(1, item)], "item_id long, text string"), documents(spark, [item, None])
    assert leaks(docs.limit(0), benchmark).count() == 0 and leaks(docs, benchmark.limit(0)).count() == 0
    assert clean(docs, benchmark.limit(0)).count() == 2 and clean(docs.limit(0), benchmark).count() == 0
    long = documents(spark, ["word " * 200_000 + item, "word " * 200_000])
    assert [(r.doc_id, r.matched, r.doc_word) for r in leaks(long, benchmark).collect()] == [(0, 13, 200_000)]


def test_clean_keeps_rows_that_share_an_id_with_a_leak(spark):
    passage = " ".join(f"word{i}" for i in range(14))
    texts = [passage, "clean one", None, passage + " more", "clean two", "clean three", passage]
    docs = documents(spark, texts, [None, None, None, 5, 5, 6, 7])
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    found = clean(docs, benchmark)
    assert found.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in found.collect()) == [(-1, ""), (-1, "clean one"), (5, "clean two"), (6, "clean three")]


def test_toxicity_learns_and_scores_odd_rows(spark):
    rng = random.Random(2)
    plain = lambda n: " ".join(rng.choice(["tree", "house", "river", "stone", "bird", "cloud"]) for _ in range(n))
    texts = [plain(rng.randint(5, 80)) + (" vile wretch " + plain(9) if i % 4 == 0 else "") for i in range(200)]
    docs = documents(spark, [*texts, None, "", "vile"], [*range(200), None, 500, 500])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    found = toxicity(docs, labels, steps=150).collect()
    assert len(found) == 203 and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and r.doc_id < 200]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held]) > 0.9


def test_toxicity_reads_all_of_long_words():
    scorer = Scorer(Network.new([], np.random.default_rng(4)))
    long = "".join(chr(0x4E00 + i) for i in range(200))
    for text in (long, "_".join(["plain"] * 30), "a" * 26):
        assert "".join(dict.fromkeys("".join(words_of(text)))) == "".join(dict.fromkeys(text))
        plain = scorer.window_logits([words_of(text)])[0]
        for at in (0, len(text) // 2, len(text) - 1):
            other = scorer.window_logits([words_of(text[:at] + "\u00e9" + text[at + 1 :])])[0]
            assert other.shape == plain.shape and (other != plain).any()
    assert words_of('A "' + "b" * 24 + '!!!" c') == ["a", '"' + "b" * 24 + '!!!"', "c"]


def test_sample_takes_one_row_of_a_doc_id(spark):
    texts = [f"text {i}" for i in range(60)]
    docs = documents(spark, texts, [1] * 50 + [2] * 8 + [3, 6])
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 6)], "doc_id long, toxic int")
    kept = [i for i in (1, 2, 3, 6) if zlib.crc32(str(i).encode()) % 5]
    found, toxic = sample(docs, labels)
    assert len(found) == len(kept) == len(toxic) and toxic.tolist() == [i % 2 for i in kept]
    again, _ = sample(docs.repartition(7), labels)
    assert found == again


def test_toxicity_without_labels(spark):
    network = train([], np.array([]))
    assert score(documents(spark, ["a", None]), network).filter("predicted = 0").count() == 2


def test_kept_text_is_sent_to_the_scorer_once(spark):
    docs = documents(spark, ["some words", None, "other words"]).select("doc_id", "text").withColumn("held_out", F.lit("old"))
    network = train([], np.array([]))
    plain, whole = score(docs, network), score(docs, network, keep_columns=True)
    assert "text_to_score" not in whole._jdf.queryExecution().optimizedPlan().toString()
    assert whole.columns == ["doc_id", "text", "held_out", "score", "predicted"]
    columns = ["doc_id", "held_out", "score", "predicted"]
    assert sorted(whole.select(*columns).collect()) == sorted(plain.select(*columns).collect())
    assert {r.text for r in whole.collect()} == {"some words", None, "other words"}


def test_word_hashes_stay_bounded():
    from marlstone.llm import part_enum

    texts = [" ".join(f"w{i}" for i in range(at, at + 1000)) for at in range(0, 300_000, 1000)]
    first = [part_enum.shingles(t, 3) for t in texts]
    assert len(part_enum._WORDS) <= 200_000
    assert all(np.array_equal(part_enum.shingles(t, 3), a) for t, a in zip(texts[::50], first[::50], strict=True))


def test_workers_forget_what_other_operators_kept(spark):
    from marlstone.llm import common, part_enum, trie_bpe
    from marlstone.llm.catalog import vocabulary

    def held(batches):
        trie_bpe.codec(vocabulary())
        part_enum.shingles("some words", 1)
        full = [len(trie_bpe._CODECS), len(part_enum._WORDS)]
        part_enum.shingles("some words", 1)
        common.forget(but=trie_bpe._CODECS)
        left = [len(trie_bpe._CODECS), len(part_enum._WORDS)]
        common.forget()
        yield from (pa.RecordBatch.from_pydict({"n": full + left + [len(trie_bpe._CODECS)]}) for _ in batches)

    found = [r.n for r in spark.range(1).coalesce(1).mapInArrow(held, "n long").collect()]
    assert found == [1, 2, 1, 0, 0]


def test_wide_rows_reach_python_in_short_batches(spark, monkeypatch):
    import corpus_pipeline
    from marlstone.llm import common, part_enum, set_sketch

    before, limits = spark.conf.get(common.ARROW_ROWS), {}

    def noted(module, name):
        store = getattr(module, name)

        def run(df, label):
            limits.setdefault((module.__name__[14:], label), spark.conf.get(common.ARROW_ROWS))
            return store(df, label)

        monkeypatch.setattr(module, name, run)

    for module in (part_enum, set_sketch):
        noted(module, "scratch_table")
        noted(module, "written")
    docs = documents(spark, ["one two three four five six", "One two three four five six", "one two three four five six seven"])
    assert groups(docs, 2, 60).filter("component_id = 0").count() == set_sketch.sketch_groups(docs, 2, 60).filter("component_id = 0").count() == 3
    of_sets = [(m, x) for m, first in (("part_enum", "signatures"), ("set_sketch", "sketches")) for x in (first, "elements", "links")]
    assert {limits[x] for x in of_sets} == {str(common.WIDE_ROWS)} and spark.conf.get(common.ARROW_ROWS) == before
    try:
        corpus_pipeline.tokens(spark, docs, "")  # written later
        sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)
        found = [r.n for r in spark.range(3000).coalesce(1).mapInArrow(sizes, "n long").collect()]
        assert sum(found) == 3000 and max(found) <= common.WIDE_ROWS
        spark.conf.set(common.ARROW_ROWS, 7)  # a lower limit stays
        with common.short_batches(spark):
            assert spark.conf.get(common.ARROW_ROWS) == "7"
    finally:
        spark.conf.set(common.ARROW_ROWS, before)


def test_archive(spark):
    rows = [(5, "u", "same"), (3, None, "same"), (3, "v", "same"), (9, "w", None), (8, "w", ""), (None, "x", "only"), (1, "y", "é" * 50000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, size string")
    found = sorted((r.page_id or -1, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in archive(pages).collect())
    digest = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert found == [
        (-1, "response", 4, digest("only"), None),
        (1, "response", 100000, digest("é" * 50000), None),
        (3, "response", 4, digest("same"), None),
        (3, "revisit", 4, digest("same"), 3),
        (5, "revisit", 4, digest("same"), 3),
        (8, "response", 0, digest(""), None),
        (9, "revisit", 0, digest(""), 8),
    ]
    small = archive(pages, min_bytes=5).filter("record_type = 'revisit'")
    assert small.count() == 0 and archive(pages.limit(0)).count() == 0
