"""Byte pieces, hard negatives and tokenizer alignment against libraries and brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mediasift.llm import align, byte_pieces, hard_negatives, html_text, langid, quality

LONG = "lorem ipsum dolor " * 9000 + "x" * 150_000
TEXTS = [None, "", " \t\n", "A b C", "a b c", "été über ñu 日本語 ½ ² \U0001f600", "one\ntwo\n\none\n", LONG, LONG,
         "a b c d e a b c d e", "<|endoftext|> don't  stop\n\n  now", "### x </turn> \\", "▁a <0x41> <unk> <s>", "\x00\x1c\x85　 x"]


# --- byte pieces ---

@pytest.fixture(scope="module")
def pieces():
    import tiktoken

    lines = open(byte_pieces.default_path(), "rb").read()
    lib = tiktoken.Encoding("own", pat_str=byte_pieces.default_pattern(), special_tokens={},
                            mergeable_ranks=byte_pieces.read_ranks(lines))
    return byte_pieces.BytePieces(lines, byte_pieces.default_pattern()), lib


@given(st.text(max_size=60) | st.text(alphabet=st.sampled_from("ab e'stré日\x1c\x85▁\n\t 12\U0001f600Ġ"), max_size=200))
@settings(max_examples=300, deadline=None)
def test_byte_pieces_equal_library_text(pieces, text):
    mine, lib = pieces
    ids = mine.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(text)
    assert mine.decode(ids) == text.encode()


def test_byte_pieces_query(spark, pieces):
    mine, lib = pieces
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, "A b C", "x"), (None, "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    got = byte_pieces.decode(byte_pieces.encode(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode_ordinary(r.text or "")
        assert bytes(r.decoded).decode() == (r.text or "")
    assert byte_pieces.decode(byte_pieces.encode(df.limit(0))).count() == 0


def test_byte_pieces_memory_does_not_matter(pieces, monkeypatch):
    mine, lib = pieces
    text = "".join(random.Random(5).choice("ab c\n") for _ in range(5000)) + "y" * 300
    monkeypatch.setattr(byte_pieces, "REMEMBERED", 10)
    monkeypatch.setattr(byte_pieces, "MATCHES", 100)
    assert np.frombuffer(mine.encode(text), "<u4").tolist() == lib.encode_ordinary(text)


def test_unmerged_tokens_stand_for_themselves():
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"xyz", b"ab"]  # no merge leads to xyz
    lines = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens))
    coder = byte_pieces.BytePieces(lines, byte_pieces.default_pattern())
    assert coder.unmerged == {b"xyz": 256}
    assert np.frombuffer(coder.encode("xyz"), "<u4").tolist() == [256]
    assert np.frombuffer(coder.encode("xyzab"), "<u4").tolist() == [120, 121, 122, 257]


# --- hard negatives ---

def brute_negatives(rows, anchor=lambda i: i % 100 == 0, label=lambda i, v: v):
    kept = {}
    for i, vec, lab in rows:
        if i is None or lab is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        kept.setdefault(i, []).append((label(i, lab), [math.floor(256 * float(x)) for x in vec]))
    out = []
    for a in sorted(kept):
        if not anchor(a):
            continue
        la, va = min(kept[a], key=lambda r: (r[0], len(r[1]), np.array(r[1], "<f8").tobytes()))
        same, other = {}, {}
        for i, versions in kept.items():
            for lab, vec in versions:
                if i == a or len(vec) != len(va):
                    continue
                score, side = sum(x * y for x, y in zip(va, vec)), same if lab == la else other
                side[i] = max(score, side.get(i, score))
        for p, ps in sorted(same.items(), key=lambda r: (-r[1], r[0]))[:5]:
            fit = [(i, s) for i, s in other.items() if 80 * ps <= 100 * s <= 100 * ps]
            for rank, (i, s) in enumerate(sorted(fit, key=lambda r: (-r[1], r[0]))[:5], 1):
                out.append((a, p, rank, i, ps, s))
    return sorted(out)


def as_rows(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def test_hard_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(3, 10))
    rows = [(int(i), [float(np.float32(x)) for x in centre[i % 3] + rng.normal(size=10) * 0.6], int(rng.integers(0, 3)))
            for i in range(0, 400)]
    rows += [(i, rows[7][1], 1) for i in range(1000, 1040)]              # ties and copies
    rows += [rows[0], rows[0], rows[5], (0, rows[9][1], 2), (5, rows[100][1], 0)]  # repeated, and one id twice
    rows += [(500, None, 1), (600, rows[3][1], None), (None, rows[3][1], 1), (700, [1.0, None], 1), (800, [float("nan")] * 10, 1),
             (900, [float("inf")] * 10, 2), (1100, [], 1), (1101, [], 1), (1102, [], 2), (1200, [0.5, 1.0], 1), (1201, [0.5, 1.0], 2),
             (1202, [0.5, 1.0], 1), (1300, [0.0] * 10, 1), (-100, rows[3][1], -1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("SCORE", F.lit("x")).withColumn(
        "slot", F.lit(1))
    want = brute_negatives([(i, v and [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows])
    assert len(want) > 50
    assert as_rows(hard_negatives.mine(df.repartition(5))) == want
    assert as_rows(hard_negatives.mine(df.repartition(3), block_bytes=2000, levels=2)) == want
    assert hard_negatives.mine(df.limit(0)).count() == 0
    assert hard_negatives.mine(df.filter("vec_id % 100 <> 0")).count() == 0


@given(st.integers(1, 17), st.integers(0, 2 ** 31), st.integers(0, 40))
@settings(max_examples=80, deadline=None)
def test_bounds_leave_out_nothing(dims, seed, spread):
    rng = np.random.default_rng(seed)
    offset = rng.normal(size=dims) * spread
    x, y = (np.floor(50 * (rng.normal(size=(n, dims)) + offset)) for n in (9, 30))
    side = lambda v: hard_negatives.Side(np.arange(len(v)), np.zeros(len(v)), v,
                                         hard_negatives._pack(hard_negatives.summarise(v)), hard_negatives.LEVELS)
    scores = (x @ y.T).astype(int)
    floor, ceiling = np.quantile(scores, 0.8, axis=1), np.quantile(scores, 0.95, axis=1)
    count = [0] * 6
    i, j, s = hard_negatives.candidates(side(x), side(y), np.ones(scores.shape, bool), floor, ceiling, count)
    want = (scores >= floor[:, None]) & (scores <= ceiling[:, None])
    assert sorted(zip(i.tolist(), j.tolist())) == sorted(zip(*(a.tolist() for a in np.nonzero(want))))
    assert (scores[i, j] == s).all()


def test_bounds_do_prune():
    rng = np.random.default_rng(0)
    x = np.floor(256 * np.repeat(rng.normal(size=(40, 16)), 16, axis=1) + rng.normal(size=(40, 256)))
    side = hard_negatives.Side(np.arange(40), np.zeros(40), x, hard_negatives._pack(hard_negatives.summarise(x)), hard_negatives.LEVELS)
    count = [0] * 6
    floor = np.sort(x @ x.T, axis=1)[:, -3]
    hard_negatives.candidates(side, side, np.ones((40, 40), bool), floor, None, count)
    assert count[0] == 1600 and count[1] >= count[3] >= count[5] and count[5] <= 140


def test_too_large_components(spark):
    df = spark.createDataFrame([(0, [1e300], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        hard_negatives.mine(df).count()


# --- alignment of two tokenizers ---

ends = st.lists(st.integers(1, 4), max_size=120)


@given(ends, ends, st.integers(1, 40))
@settings(max_examples=300, deadline=None)
def test_merge_path_equals_plain_merge(x, y, work):
    total = max(sum(x), sum(y))
    a, b = (np.cumsum([*v, total - sum(v)] if sum(v) < total else v) if total else np.empty(0, np.int64) for v in (x, y))
    i, j = align.diagonal_cuts(a, b, work)
    assert (i[0], j[0], i[-1], j[-1]) == (0, 0, len(a), len(b))
    assert (np.diff(i) + np.diff(j) <= work + 1).all()
    starts_a, starts_b = np.concatenate(([0], a))[:-1], np.concatenate(([0], b))[:-1]
    want = [(k, m, a[k] == b[m]) for k in range(len(a)) for m in range(len(b)) if max(starts_a[k], starts_b[m]) < min(a[k], b[m])]
    assert list(zip(*(v.tolist() for v in align.merge(a, b, work)))) == want


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    lib_a = Tokenizer.from_file(align.path_a_default())
    lib_a.encode_special_tokens = True
    lib_b = sentencepiece.SentencePieceProcessor(model_file=align.path_b_default())
    letter = align._byte_letters()
    out, links, counts = [], [], Counter()
    for key, text in rows:
        a = lib_a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = lib_b.encode(text) if text else []
        raw_a = [bytes(letter[c] for c in lib_a.id_to_token(i)) for i in a]
        pieces = [lib_b.id_to_piece(i) for i in b]
        raw_b = [bytes([int(p[3:5], 16)]) if lib_b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        want = (" " + (text or "")).encode()
        if not text or b"".join(raw_a) != want or b"".join(raw_b) != want:
            a = b = raw_a = raw_b = []
        ends_a, ends_b = (np.cumsum([len(r) for r in raw]).astype(int).tolist() for raw in (raw_a, raw_b))
        both = sorted(set(ends_a) & set(ends_b))
        groups, i, j, mine = [], 0, 0, []
        for end in both:
            p, q = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            mine.append((a[p - 1], b[q - 1]))
            i, j = p, q
        counts.update(mine)
        links.append(mine)
        out.append([key, len(a), len(b), len(groups), len(mine), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(n, best.get(y, 0))
    return sorted((*o[:5], sum(counts[m] == best[m[1]] for m in mine), sum(counts[m] for m in mine), o[5])
                  for o, mine in zip(out, links))


def test_alignment_equals_brute_force(spark):
    rng = random.Random(4)
    texts = [t for t in TEXTS if t is not LONG] + ["".join(rng.choice("ab c日é\n<s>12") for _ in range(rng.randint(0, 300))) for _ in range(60)]
    texts += [None, "the same", "the same", "the same again", "x" * 5000]
    rows = [(i if i != 5 else -5, t, "z") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, A_IDS string").withColumn("block", F.lit(1)).withColumn("pair", F.lit(1))
    want = brute_alignment([(i, t) for i, t, _ in rows])
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    for parts, work, block in ((3, 64, 100), (1, align.PIECE_WORK, align.BLOCK_LINKS)):
        done = align.link_counts(df.repartition(parts), work=work, block_links=block)
        assert tuple(done.columns) == names
        assert sorted(tuple(r[n] for n in names) for r in done.collect()) == want
    assert align.link_counts(df.limit(0)).count() == 0 and align.align(df.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, None), (None, ""), (None, "a b"), (7, "a b")], "doc_id long, text string")
    got = align.link_counts(nulls).collect()
    assert sorted((r.n_links, r.count_sum) for r in got) == [(0, 0), (0, 0), (2, 4), (2, 4)]


def test_alignment_of_a_long_text(spark):
    df = spark.createDataFrame([(1, LONG), (2, "lorem")], "doc_id long, text string")
    row = align.align(df).filter("doc_id = 1").head()
    a, b, ca, cb = (np.frombuffer(row[c], "<u4") for c in ("a_ids", "b_ids", "a_cuts", "b_cuts"))
    assert ca[-1] == len(a) and cb[-1] == len(b) and row.n_overlaps == len(a) + len(b) - len(ca)
    assert align.link_counts(df).filter("doc_id = 1").head().n_links == len(ca)


# --- page text ---

def _text(page, near=None):
    return html_text.article_text(page, None if near is None else html_text.signature(html_text.page_lines(near)))


def test_inline_elements_do_not_split_a_block():
    for tag in ("select", "button", "svg", "noscript", "span class=ad"):
        name = tag.split()[0]
        assert _text(f"<article><p>one <{tag}><i>x</i></{name}> two</p><p>three</p></article>") == "one two\n\nthree"
    assert _text("<article><p>one <select>two") == "one"
    assert _text("<p>a <button>b<div>c</div>d</button> e</p>") == "a e"


def test_articles_keep_lines_that_another_article_has():
    page = "<article><p>A story begins, and it goes on for a while.</p><p>Both say this.</p><p>It ends.</p></article><div>Site name</div>"
    other = "<article><p>Another one that is long enough to be the body.</p><p>Both say this.</p><p>Its end.</p></article><div>Site name</div>"
    assert _text(page, other) == "A story begins, and it goes on for a while.\n\nBoth say this.\n\nIt ends."
    # furniture of the site inside the article goes, if the other page has it outside its own
    moved = "<div>Both say this.</div>" + other.replace("<p>Both say this.</p>", "")
    assert _text(page, moved) == "A story begins, and it goes on for a while.\n\nIt ends."
    # without an article the shared lines are the site's
    plain = [f"<div>Top bar</div><div>{t}</div><div>Imprint</div>" for t in ("One story.", "Second story.")]
    assert _text(*plain) == "One story."


def test_furniture_with_unlisted_class_names():
    for name in ("comment-list", "comments-area", "site-footer", "cookie-banner", "ad-slot", "sidebar-left", "advertising", "ad_box"):
        assert _text(f"<div>Story text here.</div><div class='{name}'>Great read!</div>") == "Story text here.", name
    for name in ("content", "has-sidebar", "content-sidebar", "no-comments", "commentary", "address"):
        assert _text(f"<div class='{name}'>Story text here.</div>") == "Story text here.", name
    # an article is not dropped with a wrapper's class, but with an aside
    assert _text("<div class='sidebar-left'><article><p>Story.</p></article><p>Link</p></div>") == "Story."
    assert _text("<main><p>Long story text.</p></main><aside><article>Teaser</article></aside>") == "Long story text."


def test_long_lines_count_whole_in_the_copy_test():
    sig = lambda *lines: html_text.signature([(t, True, False) for t in lines])
    long, other = "x" * 50_000, "y" * 6_000
    assert html_text.is_copy(sig(long, other[:5_000]), sig(long, "z" * 3_000))  # 50,000 of 55,000 characters
    assert not html_text.is_copy(sig(long, other), sig(other, "z" * 50_000))


def test_no_article_line_is_lost(spark, sf="/root/testdata/sf0.01"):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    found = {r.page_id: r.text for r in html_text.extract_text(pages).select("page_id", "text").collect()}
    lost = 0
    for r in pages.collect():
        want = [t for t, a, d in html_text.page_lines(r.html) if a and not d]
        lost += len(want) - len(found[r.page_id].split("\n\n")) if want else 0
        assert not want or found[r.page_id] == "\n\n".join(want)
    assert lost == 0


# --- quality bands ---

def test_bands_reject_on_both_sides(spark, sf="/root/testdata/sf0.1"):
    rng = random.Random(6)
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("lang = 'en' AND text IS NOT NULL").select("doc_id", "text", "lang")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    plain = [t for t in texts if len(t.split()) > 150][:50]
    common = Counter(w for t in texts for w in t.split()).most_common(3)
    planted = {"shuffled": [], "tripled": [], "one word": []}
    for t in plain:
        w = t.split()
        planted["tripled"].append(" ".join(x for y in w for x in (y, y, y)))
        rng.shuffle(w)
        planted["shuffled"].append(" ".join(w))
    # new words after a very frequent one each: no 5-word window twice, and a perplexity far below the rest
    planted["one word"] = [" ".join(f"{common[0][0]} {common[0][0]}" + ("." if i % 7 == k % 7 else "") * (i % (k + 2)) for i in range(120))
                           for k in range(5)]
    rows = [(10 ** 6 + i, t, "en") for i, t in enumerate(t for v in planted.values() for t in v)]
    got = {r.doc_id: r for r in quality.judge_quality(docs.unionByName(spark.createDataFrame(rows, docs.schema))).collect()}
    at = 10 ** 6
    for name, v in planted.items():
        rejected = sum(not got[at + i].kept for i in range(len(v))) / len(v)
        at += len(v)
        assert rejected >= (0.6 if name != "one word" else 1.0), (name, rejected)
    clean = [r for i, r in got.items() if i < 10 ** 6 and not r.base_failed and r.n_symbols <= 0.1 * r.n_words]
    assert sum(r.kept for r in clean) >= 0.95 * len(clean)


def test_lower_limit_rejects_by_perplexity_alone():
    z = lambda text, model: (lambda k: (-model.log10(k).astype(float).mean(), len(k)))(quality.trigram_keys(text))
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(300)] + ["the"]
    texts = [" ".join(rng.choices(words, [1] * 300 + [60], k=200)) for _ in range(200)]
    keys = np.concatenate([quality.trigram_keys(t) for t in texts])
    model = quality.KneserNey(*np.unique(keys, return_counts=True))
    values = np.array([z(t, model) for t in texts])
    mid = np.median(values[:, 0])
    scaled = (values[:, 0] - mid) * np.sqrt(values[:, 1])
    low = quality.BAND_DEVIATIONS * 1.4826 * np.median(-scaled[scaled < 0])
    value, n = z(" ".join(["the"] * 200), model)
    assert (value - mid) * np.sqrt(n) < -low and (scaled >= -low).all()


def test_segment_medians():
    rng = np.random.default_rng(0)
    sizes = np.array([1, 5, 99, 149, 151, 1000, 2])
    values = rng.random(sizes.sum())
    got, at = quality.segment_medians(values, sizes, 100), 0
    for n, v in zip(sizes, got):
        c = max(1, round(n / 100))
        cut = [i * n // c for i in range(c + 1)]
        assert np.isclose(v, np.median([values[at + a:at + b].mean() for a, b in zip(cut, cut[1:])]))
        at += n


def test_a_passage_does_not_move_the_median():
    values = np.concatenate((np.full(900, 0.7), np.full(200, 3.0), np.full(900, 0.7)))
    assert np.isclose(quality.segment_medians(values, np.array([2000]))[0], 0.7)


# --- language ID: words of any length ---

def test_expected_uses_of_long_words_are_the_gradient():
    pieces = sorted(["▁", "▁a", "a", "b", "ab", "ba", "aab", "c", "bc"])
    seg, rng = langid.Segmenter(pieces), np.random.default_rng(4)
    prob = rng.random((len(pieces) + 1, 2)) / 20
    for words in (["".join(rng.choice(list("abcd"), 60)), "abc", "".join(rng.choice(list("abc"), 31)), ""], ["ab" * 900], ["bca"]):
        counts = rng.integers(1, 4, (len(words), 2)).astype(float)
        got = seg.expected(words, counts, prob)
        for piece in range(len(pieces) + 1):
            up, down = prob.copy(), prob.copy()
            up[piece] *= 1.0001
            down[piece] /= 1.0001
            slope = (counts * (seg.log_prob(words, up) - seg.log_prob(words, down))).sum(axis=0) / (2 * np.log(1.0001))
            np.testing.assert_allclose(got[piece], slope, rtol=1e-4, atol=1e-4)


def test_languages_without_spaces_are_learned():
    rng = np.random.default_rng(5)
    letters = {"one": ["の人", "日本", "国に", "月は"], "two": ["中国", "人民", "日月", "本的"]}
    def sentence(lang):
        return "".join(rng.choice(letters[lang], 30))
    rows = [(sentence(lang), lang) for lang in letters for _ in range(20)]
    pieces = langid.vocabulary()
    langs, prob = langid.fit(rows, pieces)
    fresh = [lang for lang in letters for _ in range(50)]
    pred, _ = langid.Identifier(langs, prob, pieces).predict([sentence(lang) for lang in fresh])
    assert pred == fresh
