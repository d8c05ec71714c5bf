"""Text operators against brute force, and on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mediasift.llm import bpe, chat, decontam, html_text, langid, lm, quality, simhash, toxicity, urls
from mediasift.llm.components import connected_components

LONG = "lorem ipsum dolor " * 9000 + "x" * 150_000
TEXTS = [None, "", " \t\n", "A b C", "a b c", "été über ñu 日本語 ½ ² \U0001f600", "one\ntwo\n\none\n", LONG, LONG,
         "a b c d e a b c d e a b c d e f", "<|endoftext|> don't  stop\n\n  now", "### x </turn> \\"]


def awkward(spark):
    """Nulls in any column, repeated rows, clashing extra columns."""
    rows = [(i, t, None if i % 4 == 0 else "en", True, "q") for i, t in enumerate(TEXTS)]
    rows += [rows[3], rows[3], (None, "a b c", "en", None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, Score boolean, kept string")


def crc(i):
    return zlib.crc32(str(i).encode())


# --- URLs ---

def test_urls(spark):
    df = spark.createDataFrame([(u, 1) for u in (
        None, "", "no scheme", "http://NET/x", "http://a.b.Example.net/en/1?q", "https://x.example.net/en", "http://net",
        "http://example.com/de/#f", "http://x.org/fr/a", "http://notexample.com/de/", "a://b://c.net/")], "url string, RULE int")
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(df).collect()}
    assert got[None] == got[""] == got["no scheme"] == ("", "", None, "allow")
    assert got["http://NET/x"] == ("net", "/x", "net/", "block")
    assert got["http://a.b.Example.net/en/1?q"] == ("a.b.example.net", "/en/1", "example.net/en/", "allow")
    assert got["https://x.example.net/en"][2:] == ("net/", "block")
    assert got["http://net"] == ("net", "", None, "allow")
    assert got["http://example.com/de/#f"][2:] == ("example.com/de/", "block")
    assert got["http://x.org/fr/a"][2:] == ("org/fr/", "allow")
    assert got["http://notexample.com/de/"][2] is None
    assert got["a://b://c.net/"][0] == "b:"
    assert urls.filter_urls(df.limit(0)).count() == 0


@given(st.lists(st.tuples(st.lists(st.sampled_from("ab"), max_size=3), st.lists(st.sampled_from("xy"), max_size=3),
                          st.sampled_from(["allow", "block"])), max_size=6),
       st.lists(st.sampled_from("ab"), min_size=1, max_size=4), st.lists(st.sampled_from("xy"), max_size=4))
@settings(max_examples=200, deadline=None)
def test_trie_equals_scan(rules, host, path):
    rules = [(".".join(h), "/" + "/".join(p), v) for h, p, v in rules]
    host, path = ".".join(host), "/" + "/".join(path)
    fits = [(h.count(".") + 1 if h else 0, len(p), v == "block", h + p, v) for h, p, v in rules
            if ("." + host).endswith("." + h if h else "") and path.startswith(p)]
    assert urls.UrlTrie(rules).match(host, path) == (max(fits)[3:] if fits else None)


# --- decontamination ---

def test_decontamination(spark):
    item = "The quick-brown fox; jumps over é lazy dogs and then 12 sleeps"
    items = spark.createDataFrame([(1, item), (1, item), (10, "short one"), (2, "!!"), (3, None), (None, "short one")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, f"Intro {item.upper().replace('É', 'é')}!"), (2, "a SHORT, one two short one"), (3, None),
                                  (4, ""), (5, "shorter one"), (6, item[:40])], "doc_id long, text string").withColumn(
                                      "N_HIT", F.lit("clash"))
    got = {r.doc_id: r for r in decontam.find_contamination(docs, items).collect()}
    n = len(decontam.normal_words(item))
    assert (got[1].n_hit, got[1].items) == (n, ["1"]) and got[1].n_words == n + 1
    (span,) = got[1].spans
    assert (span.start, span.end) == (6, 6 + len(item))
    assert (got[2].n_hit, got[2].items) == (4, ["10"]) and len(got[2].spans) == 2
    assert got[3].n_words == got[4].n_words == got[5].n_hit == got[6].n_hit == 0
    assert decontam.find_contamination(docs, items.limit(0)).filter("n_hit > 0").count() == 0
    assert decontam.find_contamination(docs.limit(0), items).count() == 0
    assert decontam.find_contamination(awkward(spark), items).count() == len(TEXTS) + 4


# --- BPE ---

@pytest.fixture(scope="module")
def coder():
    with open(bpe.default_path(), encoding="utf-8") as f:
        return bpe.ByteBpe(f.read())


@given(st.text(alphabet=st.sampled_from("aabbt e'é\n 1-日"), max_size=200), st.data())
@settings(max_examples=150, deadline=None)
def test_bpe_join_is_exact(text, data):
    coder = bpe._bpe(open(bpe.default_path(), encoding="utf-8").read())
    raw = text.encode()
    cuts = sorted({data.draw(st.integers(0, len(raw))) for _ in range(4)} | {0, len(raw)})
    leaves = [coder.encode_piece(raw[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]
    if leaves:
        assert coder.tree(leaves).tolist() == coder.encode_piece(raw).tolist()


def test_bpe_equals_library(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.default_path())
    unsplit = "".join(random.Random(3).choice("abcdefgh") for _ in range(5000))
    texts = TEXTS + [unsplit, "x " + unsplit + "\n\n y 12'll" + "!" * 900 + unsplit, "日本" * 900, "\n \n" * 500 + "a  b" * 300]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[-2:])], "i long, text string").withColumn("IDS", F.lit(1))
    for leaf in (bpe.LEAF_CHARS, 256):
        done = bpe.decode(bpe.encode(df, leaf_chars=leaf)).collect()
        assert len(done) == len(texts) + 2
        for r in done:
            assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode(r.text or "", add_special_tokens=False).ids
            assert r.decoded == (r.text or "")
    assert bpe.encode(df.limit(0)).count() == 0


# --- SimHash ---

def brute_groups(rows):
    def fp(text):
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    fps = {t: fp(t) for _, t in rows}
    distinct = sorted(set(fps.values()))
    root = {f: f for f in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 3 and root[a] != root[b]:
                old, new = root[a], root[b]
                root = {f: new if r == old else r for f, r in root.items()}
    best = {}
    for i, t in rows:
        if i is not None:
            r = root[fps[t]]
            best[r] = min(best.get(r, i), i)
    return [(i, fps[t], best.get(root[fps[t]])) for i, t in rows]


def near_texts():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for g in range(12):
        base = rng.choices(words, k=300)
        for c in range(6):
            copy = list(base)
            for _ in range(c // 2):
                copy[rng.randrange(300)] = rng.choice(words)
            rows.append((len(rows) * 7 % 101, " ".join(copy)))
    return rows


def test_simhash_equals_brute_force(spark):
    rows = near_texts() + [(500 + i, t) for i, t in enumerate(TEXTS)] + [(None, "a b c"), (503, "A b C")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1))
    want = sorted(brute_groups(rows), key=repr)
    for most in (simhash.MAX_BUCKET, 2):  # 2: nearly all buckets go to the finer tables
        got = [(r.id, r.fp % (1 << 64), r.component_id) for r in simhash.simhash_groups(df, max_bucket=most).collect()]
        assert sorted(got, key=repr) == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted({c for _, _, c in want})
    assert simhash.simhash_groups(df.limit(0)).count() == simhash.keep_one(df.limit(0)).count() == 0


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=6), st.integers(0, 2**32))
@settings(max_examples=40, deadline=None)
def test_gray_index_connects_what_is_near(seeds, noise):
    rng = random.Random(noise)
    fps = {s for s in seeds}
    for s in seeds:
        for _ in range(30):
            for _ in range(rng.randrange(1, 5)):
                s ^= 1 << rng.randrange(64)
            fps.add(s)
    fps = np.array(sorted(fps), np.uint64)
    a, b = simhash.GrayIndex(fps).links(3)
    assert (np.bitwise_count(a ^ b) <= 3).all()
    part = {int(f): int(f) for f in fps}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        assert find(x) != find(y)  # a forest
        part[find(x)] = find(y)
    for x in fps:
        for y in fps[np.bitwise_count(fps ^ x) <= 3]:
            assert find(int(x)) == find(int(y))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 300: 200}
    assert got == want


# --- quality ---

def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)]


@given(st.lists(st.text(alphabet=st.sampled_from("ab \n\t#é"), max_size=60), max_size=5))
@settings(max_examples=150, deadline=None)
def test_base_columns(texts):
    texts = [*texts, None]
    assert [list(x) for x in zip(*(c.tolist() for c in quality.base_columns(texts)))] == [brute_base(t) for t in texts]


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(1)
    keys = np.concatenate([quality.trigram_keys("".join(rng.choice(list("abcde "), 60))) for _ in range(50)])
    model = quality.KneserNey(*np.unique(keys, return_counts=True))
    for context in (*np.unique(keys >> 7)[:5].tolist(), 99 << 7 | 98, 120 << 7 | 120):
        k = (np.uint32(context) << np.uint32(7)) | np.arange(128, dtype=np.uint32)
        assert abs((10.0 ** model.log10(k).astype(float)).sum() - 1) < 1e-4


def test_quality(spark):
    rng = random.Random(2)
    say = lambda: " ".join(rng.choice("the of and in river stone light under over water".split()) for _ in range(60))
    rows = [(i, say(), "en") for i in range(60)] + [(100, "ZQ!! XV!! " + " ".join(f"Q{k}X!!" for k in range(40)), "en"),
                                                    (101, "too short", "en"), (102, say(), "one-text"), (103, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("KEPT", F.lit("x"))
    kept = {r.doc_id: r.kept for r in quality.judge_quality(df).collect()}
    assert all(kept[i] for i in range(60)) and not (kept[100] or kept[101] or kept[103])
    good = quality.keep_good(df.drop("KEPT"))
    assert good.columns == ["doc_id", "text", "lang"] and {r.doc_id for r in good.collect()} == {i for i in kept if kept[i]}
    assert quality.judge_quality(awkward(spark)).count() == len(TEXTS) + 4
    assert quality.judge_quality(df.limit(0)).count() == 0


# --- language ---

def test_forward_sums_all_segmentations():
    pieces = sorted(["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "aba"])
    seg, prob = langid.Segmenter(pieces), np.random.default_rng(0).random((len(pieces) + 1, 3)) / 4
    at = {p: i for i, p in enumerate(pieces)}

    def brute(s):
        return 1.0 if not s else sum(
            prob[at.get(s[:k], seg.n)] * brute(s[k:]) for k in range(1, len(s) + 1) if s[:k] in at or k == 1)

    words = ["a", "b", "abab", "xaybb", "ababababab"]
    assert np.allclose(seg.log_prob(words, prob), [np.log(brute("▁" + w)) for w in words])
    e = seg.expected(["ab"], np.ones((1, 3)), prob)
    ways = [("▁", "a", "b"), ("▁", "ab"), ("▁a", "b"), ("▁ab",)]
    p = np.array([np.prod([prob[at[x]] for x in w], axis=0) for w in ways])
    assert np.allclose(e[at["ab"]], p[1] / p.sum(axis=0)) and np.allclose(e[at["b"]], (p[0] + p[2]) / p.sum(axis=0))
    text, logs = "▁" + "abxba" * 400, [np.zeros(3)]  # a long word is scaled on the way
    for i in range(1, len(text) + 1):
        logs.append(np.logaddexp.reduce([
            logs[j] + np.log(prob[at.get(text[j:i], seg.n)]) for j in range(max(0, i - 4), i) if text[j:i] in at or j == i - 1]))
    assert np.allclose(seg.log_prob([text[1:]], prob)[0], logs[-1])


def test_language_id(spark, sf="/root/testdata/sf0.01"):
    got = langid.op1_language_id(spark, sf).toPandas()
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert len(got) == len(truth) and (held.lang == held.lang_pred).mean() > 0.97
    assert (both.held_out == both.doc_id.map(lambda i: crc(i) % 5 == 0)).all()
    pieces = langid.vocabulary()
    langs, prob = langid.fit([("the river and the stone", "en"), ("der Fluss und die Steine", "de")], pieces)
    out = langid.identify(awkward(spark), langs, prob, pieces).collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in out if r.text is None or not r.text.strip())
    assert all(r.lang_pred in langs for r in out if r.text and r.text.strip())
    assert langid.identify(awkward(spark).limit(0), [], prob[:, :0], pieces).count() == 0


# --- chat ---

def test_chat_round_trip(spark):
    texts = ["", "hi", "\\### Assistant: </turn> ok", "### ##### </turn></turn> \\\\", "x" * 50, " y ", "é\n\n"]
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "sy: st ### em"]), rng.choice(texts))
            for c, n in ((1, 2), (2, 100), (3, 5000), (4, 1)) for t in range(n)]
    rows += [(5, None, None, None), (5, 0, "assistant", None), (5, 0, "assistant", "a"), (5, 0, "assistant", "a"), (None, 1, "assistant", "z")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("N_TURNS", F.lit(0))
    t = chat.MarkedTemplate()
    want = {}
    for c in {r[0] for r in rows}:
        own = sorted([(-1 if n is None else n, r or "", x or "") for k, n, r, x in rows if k == c])
        loss = "".join(x for _, r, x in own if r == "assistant")
        want[c] = (len(own), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest(), len(loss),
                   hashlib.sha256(loss.encode()).hexdigest(), len(t.render([(r, x) for _, r, x in own])))
    got = {None if r.conv is None else int(r.conv): tuple(r)[1:] for r in chat.conversation_digests(df).collect()}
    assert got == want  # conversation 3 is over HOT_ROWS: several blocks
    pieces = chat.format_conversations(df).orderBy("conv", "block", "part").collect()
    for c in want:
        own = sorted([(-1 if n is None else n, r or "", x or "") for k, n, r, x in rows if k == c])
        assert "".join(p.formatted for p in pieces if p.conv == (None if c is None else str(c))) == t.render([(r, x) for _, r, x in own])
    assert chat.conversation_digests(df.limit(0)).count() == 0


def test_template_that_rewrites_history():
    def render(turns):  # shows thoughts in the last turn only
        return "".join(f"<{r}>{x if k == len(turns) - 1 else re.sub('<think>.*?</think>', '', x)}</{r}>" for k, (r, x) in enumerate(turns))

    turns = [("u", "a"), ("s", "<think>t</think>b"), ("u", "c")]
    found = chat.conversation_spans(render, turns)
    assert found["rewritten"] == 2 and found["output"] == "<u>a</u><s>b</s><u>c</u>"
    assert [found["output"][a:b] for a, b in found["spans"]] == ["a", "b", "c"]
    assert not chat.adds_the_same_text(render) and chat.adds_the_same_text(chat.MarkedTemplate().render)


# --- toxicity ---

def test_gradients():
    rng = np.random.default_rng(0)
    words = ["ab", "abc", "xyz", "longer", "a"]
    inputs, ids = toxicity.word_inputs(words), np.array([[1, 2, 3, 0], [4, 5, 1, 2], [3, 0, 0, 0]])
    label, weight = np.array([1.0, 0.0, 1.0]), np.ones(3)
    net = toxicity.Net(3)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)

    def loss():
        x = np.concatenate((np.zeros((1, toxicity.WORD_DIM + toxicity.CHAR_DIM)), net.embed(inputs)))
        z = net.forward(net.project(x), ids).astype(float)
        return float((np.log1p(np.exp(z)) - label * z).mean())

    before = {k: v.copy() for k, v in net.p.items()}
    net.g2 = {k: np.zeros(v.shape) for k, v in net.p.items()}
    with np.errstate(invalid="ignore", divide="ignore"):
        net.train(inputs, ids, label, weight, rate=0.0)
    grads = {k: np.sqrt(v) for k, v in net.g2.items()}  # squares of one step
    net.p = before
    for k in before:
        flat = np.argsort(-grads[k].ravel())[:3]
        for i in flat:
            at, eps = np.unravel_index(i, before[k].shape), 1e-2
            old = net.p[k][at]
            net.p[k][at] = old + eps
            up = loss()
            net.p[k][at] = old - eps
            down = loss()
            net.p[k][at] = old
            assert abs(abs(up - down) / (2 * eps) - grads[k][at]) < 0.02 * grads[k][at] + 2e-4, k


def test_windows_cover_every_token():
    for sizes in ([0, 1, 32, 33, 56, 57, 500, 0], [0], []):
        ends = np.cumsum(sizes)
        ids = np.arange(1, sum(sizes) + 1)
        win, owner = toxicity.windows(ids, ends)
        assert set(win.ravel().tolist()) - {0} == set(ids.tolist())
        for w, o in zip(win, owner):
            live = w[w > 0]
            assert live.min() > ends[o] - sizes[o] and live.max() <= ends[o] and (np.diff(live) == 1).all()


def test_toxicity(spark, sf="/root/testdata/sf0.1"):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.training_rows(docs, labels)
    net = toxicity.train(rows, rounds=2)
    held = docs.join(labels.select("doc_id", "toxic"), "doc_id").filter("crc32(cast(string(doc_id) as binary)) % 5 = 0")
    got = toxicity.score_toxicity(held, net).toPandas()
    pred = got.score >= 0.5
    assert (pred == (got.toxic == 1)).mean() > 0.94 and got.score.between(0, 1).all()
    out = toxicity.score_toxicity(awkward(spark).drop("Score"), net).collect()
    assert all(r.score == 0 for r in out if not (r.text or "").strip()) and len(out) == len(TEXTS) + 4
    assert toxicity.train([("a", 0)]) is None and toxicity.train([]) is None
    assert toxicity.score_toxicity(docs, None).filter("score <> 0").count() == 0
    assert toxicity.training_rows(docs.limit(0), labels) == []


# --- pages ---

@given(st.lists(st.integers(0, 4), max_size=30), st.lists(st.integers(0, 4), max_size=30))
@settings(max_examples=200, deadline=None)
def test_common_lines(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    kept = [x for x, k in zip(a, html_text.common_lines(a, b)) if k]
    rest = iter(b)
    assert len(kept) == table[-1][-1] and all(x in rest for x in kept)


def test_pages(spark):
    site = "<div>Home | News</div><p>Contact us</p>"
    rows = [
        (1, "http://h.com/a/1", f"<body>{site}<p>First &amp; only\n story<br>goes on</p><p>Tail</p></body>"),
        (2, "http://h.com/a/2", f"<body>{site}<p>Second story</p></body>"),
        (3, "http://other.com/a/1", f"<body>{site}<p>Alone</p></body>"),
        (4, "http://h.com/b/9", "<nav>x</nav><article><h1>T</h1><p>Same text<p>in two pages<script>var a='</p>'</script></article>"
                                "<aside>y</aside><div class='ad box'>z</div><footer>f</footer>"),
        (5, "http://h.com/b/91", "<nav>x</nav><article><h1>T</h1><p>Same text<p>in two pages</article><p>outside</p>"),
        (6, None, None), (7, "no scheme", ""), (8, "http://h.com/c", "a < b <!-- c --> &lt;d&gt; <b>bold</b>ly"),
        (9, "http://z.com/", "<div id=comments>bad</div>good" + "<p>word</p>" * 3000),
    ]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("TEXT", F.lit(0))
    for parts in ("1", "8"):  # neighbours do not depend on the ranges
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = html_text.extract_text(df).collect()
        text = {r.page_id: r.text for r in got}
        assert len(got) == len(rows)
        assert text[1] == "First & only story goes on\n\nTail" and text[2] == "Second story"
        assert text[3] == "Home | News\n\nContact us\n\nAlone"
        assert text[4] == text[5] == "T\n\nSame text\n\nin two pages"
        assert text[6] == text[7] == "" and text[8] == "a < b <d> boldly"
        assert text[9] == "\n\n".join(["good"] + ["word"] * 3000)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert html_text.extract_text(df.limit(0)).count() == 0


def test_pages_differencing_decides_before_tags(spark):
    long = lambda k: f"This is the body of page {k}, " + f"and it says a lot about matter {k} " * 5 + "."
    rows = [(i, f"http://teaser.com/{i}", f"<article><p>Read more</p></article><div><p>{long(i)}</p></div>") for i in range(3)]
    rows += [(10 + i, f"http://inside.com/{i}", f"<article><div class=box>Buy our book</div><p>{long(i)}</p><div>All rights kept</div></article><p>Top</p>")
             for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r.page_id: r.text for r in html_text.extract_text(df).collect()}
    assert text == {k + i: long(i) for k in (0, 10) for i in range(3)}


@pytest.mark.parametrize("around", [
    '<body class="post has-sidebar">{}', '<body class="comments">{}', '<html id=menu><body class="no-comments">{}',
    '<article class="post category-social">{}</article>', '<main class="social">{}</main>', '<article id=related>{}</article>',
    '<div id="content" class="content-sidebar">{}</div>'])
def test_pages_class_words(around):
    page = around.format('<p>Story</p><div class="Sidebar left">no</div><p id="comments">no</p>')
    assert html_text.article_text(page, None) == "Story"


def test_pages_copies_do_not_erase_each_other(spark):
    site = "<div>Home | News</div><div>Contact us</div>"
    story = lambda k: "".join(f"<div>Line {i} of story {k}, which is long enough</div>" for i in range(12))
    own = lambda k: [f"Line {i} of story {k}, which is long enough" for i in range(12)]
    rows = [(1, "http://h.com/a?utm=1", site + story(1)), (2, "http://h.com/a?utm=2", site + story(1)),
            (3, "http://h.com/b", site + story(2)), (4, "http://only.com/x", story(3)), (5, "http://only.com/y", story(3))]
    # a run of near copies over several ranges, and the pages before and behind it
    rows += [(100 + i, f"http://run.com/m/{i:03}", site + story(4) + f"<div>visit {i}</div>") for i in range(40)]
    rows += [(200, "http://run.com/a", site + story(5)), (201, "http://run.com/z", site + story(6))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        text = {r.page_id: r.text.split("\n\n") for r in html_text.extract_text(df).collect()}
        assert text[1] == text[2] == own(1) and text[3] == own(2)
        assert text[4] == text[5] == own(3)
        assert all(text[100 + i] == [*own(4), f"visit {i}"] for i in range(40))
        assert text[200] == own(5) and text[201] == own(6)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


# --- LM scores ---

def test_lm_blocks_equal_one_model(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["the", "The", "of", "x", f"w{rng.randrange(30)}"]) for _ in range(rng.randrange(40))))
            for i in range(300)] + [(None, None), (None, ""), (7, "the the"), (7, "the the"), (400, LONG)]
    rows += [(500 + i, f"the own{i} word{i} of {i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("SCORE", F.lit("x"))
    learns = [crc("" if i is None else i) % 5 != 1 for i, _ in rows]
    words = [[w for w in (t or "").lower().split()] + [None] for _, t in rows]
    uni, pairs, triples = Counter(), Counter(), Counter()
    for w, ok in zip(words, learns):
        if ok:
            uni.update(w)
            pairs.update(zip([0, *w[:-1]], w))
            triples.update(zip([0, *w[:-2]], w[:-1], w[1:]))
    n, v = sum(uni.values()), len(uni)
    p = lambda w: (uni[w] + 0.5) / (n + 0.5 * (v + 1))
    want, levels = [], set()

    def backed_off(a, b, w):  # a plain recursive back-off model; ``a`` is False where there is no word before ``b``
        c2 = pairs[a, b] if a is not False else 0
        if c2:
            if triples[a, b, w]:
                levels.add(3)
                return (triples[a, b, w] + m3 * backed_off(False, b, w)) / (c2 + m3)
            return m3 / (c2 + m3) * backed_off(False, b, w)
        c = uni[None] if b == 0 else uni[b]
        if not c or not pairs[b, w]:
            levels.add(1 if c else 0)
            return (m2 / (c + m2) if c else 1) * p(w)
        levels.add(2)
        return (pairs[b, w] + m2 * p(w)) / (c + m2)

    m2, m3 = lm.PRIORS
    for (i, _), w in zip(rows, words):
        base = sum(np.log10(p(x)) for x in w)
        before = [(False, 0), (0, w[0]), *zip(w, w[1:])][:len(w)]
        score = sum(np.log10(backed_off(a, b, x)) for (a, b), x in zip(before, w))
        want.append((-1 if i is None else i, len(w), sum(uni[x] > 0 for x in w), n, round(base, 6), round(score, 6)))
    from mediasift.llm.common import fold

    got = lm.score_texts(df, learn=fold() != 1, block_rows=16)
    got = [(-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
           for r in got.collect()]
    assert sorted(got) == sorted(want) and levels == {0, 1, 2, 3}
    assert lm.score_texts(df.limit(0)).count() == 0
    none = lm.score_texts(df, learn=F.lit(False)).agg(F.max("n_known"), F.max("train_tokens")).first()
    assert tuple(none) == (0, 0)


def test_lm_blocks_and_shards_follow_bytes(spark, monkeypatch):
    rng = random.Random(10)
    rows = [(i, " ".join(f"w{rng.randrange(50)}" for _ in range(200 if 40 <= i < 80 else 5))) for i in range(200)]
    df = spark.createDataFrame([*rows, (None, None), (200, "")], "doc_id long, text string").coalesce(1)
    blocks, total = lm._with_blocks(df, [F.col("text").alias("_text")], 64, 2000)
    sizes = [r.b for r in blocks.groupBy("_file", "_no").agg(F.sum(F.octet_length("_text")).alias("b")).collect()]
    assert total == sum(len(t) for _, t in rows) and blocks.count() == 202
    assert max(sizes) <= 2000 + max(len(t) for _, t in rows) and len(sizes) < 30
    seen, inner = [], lm._asked
    monkeypatch.setattr(lm, "_asked", lambda shards, drop: seen.append(shards) or inner(shards, drop))
    columns = ("doc_id", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6), F.round("score", 6))
    want = sorted(map(str, lm.score_texts(df).select(*columns).collect()))
    small = sorted(map(str, lm.score_texts(df, block_rows=64, block_bytes=2000, shard_bytes=1000).select(*columns).collect()))
    assert small == want and seen == [8, -(-total // 1000)]


def test_chat_undeclared_templates_get_real_prefixes(spark):
    class LateTemplate(chat.MarkedTemplate):
        """Shortens turns behind the 36th: no probe has a history of that length."""

        def render(self, turns):
            plain = chat.MarkedTemplate()
            return plain.render([(r, t if k < 36 else t[:3]) for k, (r, t) in enumerate(turns)])

    turns = [("user" if k % 2 else "assistant", f"turn {k}") for k in range(50)]
    df = spark.createDataFrame([(1, k, r, t) for k, (r, t) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    for template in (LateTemplate(), chat.MarkedTemplate()):
        got = chat.format_conversations(df, template).orderBy("block", "part").collect()
        assert "".join(r.formatted for r in got) == template.render(turns)
    assert chat.is_local(chat.MarkedTemplate()) and not chat.is_local(LateTemplate())
