"""Operators 1, 2, 3, 4, 5, 9 and 10 against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import collections
import hashlib
import html
import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from wattlake.llm import decontam, kn_lm, langid, mixing, quality, token_repair, wrappers
from wattlake.llm.queries import ORACLE_SQL, tokenizer_file

SF = "/root/testdata/sf0.001"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 400, 60)
    ids = rng.zipf(1.4, sizes.sum()) % 300
    rules, lengths, seq, symbols = token_repair.repair(ids, sizes, 1 << 17, 8)
    assert len(rules) and len(seq) < len(ids) and symbols.sum() == len(seq)
    assert (token_repair.expand(seq, rules, lengths, 1 << 17) == ids).all()
    row = {"symbols": symbols.astype(np.uint32).tobytes(), "rules": rules.astype(np.uint32).tobytes(), "base": 1 << 17,
           "lengths": lengths.astype(np.uint32).tobytes(), "low": (seq & 0xFFFF).astype(np.uint16).tobytes(),
           "high": (seq >> 16).astype(np.uint16).tobytes()}
    cuts = np.cumsum(sizes)
    for i in (0, 7, 59):
        assert (token_repair.document(row, i) == ids[cuts[i] - sizes[i]:cuts[i]]).all()


def test_tokens_equal_whole_text_encoding(docs):
    tok = Tokenizer.from_file(tokenizer_file())
    out = token_repair.tokenize_corpus(docs, tokenizer_file()).collect()
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or ""))
    start, want = 0, []
    for r in rows:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r[:4]) for r in out), key=lambda r: r[1]) == want


def test_tokens_of_an_empty_table_and_of_one_hot_doc_id(spark, empty, tmp_path):
    assert token_repair.tokenize_corpus(empty, tokenizer_file()).count() == 0
    tok = Tokenizer.from_file(tokenizer_file())
    for hot in (7, None):
        rows = [(hot, f"text number {i % 250} of the hot id") for i in range(400)] + [(i, f"other {i}") for i in range(100)]
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        shards = token_repair.write_shards(frame, str(tmp_path / f"shards{hot}"), tokenizer_file())
        parts = collections.Counter(r.part for r in shards.collect()
                                    for d, n in zip(np.frombuffer(r.doc_ids, np.int64), np.frombuffer(r.nulls, np.uint8))
                                    if (n and hot is None) or (not n and d == hot))
        assert len(parts) > 1 and max(parts.values()) < 300, "the hot id is spread over parts"
        got = token_repair.read_documents(shards).orderBy("start").collect()
        want = collections.Counter((d, zlib.crc32(np.array(tok.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes()))
                                   for d, t in rows)
        assert collections.Counter((r.doc_id, r.ids_crc32) for r in got) == want
        order = [(r.doc_id is None, r.doc_id or 0) for r in got]
        assert order == sorted(order)
        ends = np.cumsum([r.n_tokens for r in got])
        assert [r.start for r in got] == [0, *ends[:-1].tolist()]


def test_grammar_is_complete_and_equal_to_pair_counts():
    rng = np.random.default_rng(5)
    words = [rng.integers(0, 5000, rng.integers(2, 6)) for _ in range(400)]
    ids = np.concatenate([words[i] for i in rng.zipf(1.3, 9000) % 400])[:20000]
    sizes = np.array([5000, 1, 0, 9999, 5000])
    left = []
    for least in (256, 16, 4):
        rules, lengths, seq, symbols = token_repair.repair(ids, sizes, 1 << 17, least)
        assert (token_repair.expand(seq, rules, lengths, 1 << 17) == ids).all() and symbols[2] == 0
        cuts = np.cumsum(symbols)
        # disjoint places of a pair inside documents: none is left that often
        count, last = collections.Counter(), {}
        for a, b in zip(cuts - symbols, cuts):
            for i in range(a, b - 1):
                pair = (int(seq[i]), int(seq[i + 1]))
                if last.get(pair) != i - 1 or pair[0] != pair[1]:
                    count[pair] += 1
                    last[pair] = i
        assert max(count.values()) < least
        left.append(len(seq) + 2 * len(rules))
    assert left[2] < left[1] < left[0] and left[2] < 0.6 * len(ids)


def test_contamination_both_paths(spark, docs, empty):
    items = [(1, "brown fox jumps over the lazy dog while seven small birds sing on an old"), (2, "One two THREE"),
             (2, "quiet river"), (None, "42 tables"), (3, None), (4, ""), (5, "never anywhere at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for s in range(max(0, len(w) - 13) + 1 if w else 0):
            windows[tuple(w[s:s + 13])].add("" if i is None else str(i))
    want = []
    for r in docs.collect():
        w, found = words(r.text), set()
        hit = [False] * len(w)
        for key, ids in windows.items():
            for s in range(len(w) - len(key) + 1):
                if tuple(w[s:s + len(key)]) == key:
                    found |= ids
                    hit[s:s + len(key)] = [True] * len(key)
        want.append((r.doc_id, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                     sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    for most in (10 ** 6, 0):
        got = decontam.find_contamination(docs, bench, broadcast_max=most)[0].drop("ref").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert decontam.find_contamination(empty, bench)[0].count() == 0
    assert not any(r.n_items for r in decontam.find_contamination(docs, bench.where("item_id = 99"))[0].collect())


def test_fingerprints_of_a_very_long_text():
    h = np.random.default_rng(4).integers(0, 1 << 63, (1 << 24) + 5000).astype(np.uint64)
    off = np.array([0, 7, 7, decontam.SLICE - 20, decontam.SLICE + 6, len(h)])
    value, pos = decontam.fingerprints(h, off, 13)
    assert len(np.unique(pos)) == len(pos)
    for a in (decontam.SLICE + 6, 2 * decontam.SLICE - 40, 2 * decontam.SLICE + 4000):
        want = decontam.fingerprints(h[a:a + 60], np.array([0, 60]), 13)
        assert set(zip(want[0], want[1] + a)) <= set(zip(value[(pos >= a) & (pos < a + 60)], pos[(pos >= a) & (pos < a + 60)]))
    assert not ((pos < 7) | (pos + 5 > decontam.SLICE - 20) & (pos < decontam.SLICE - 20)).any()


def test_kneser_ney_against_formulas(docs, empty):
    rows = [(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", lower(r.text)) + ["</s>"]) for r in docs.collect()]
    held = lambda d: zlib.crc32(str("" if d is None else d).encode()) % 7 == 2
    pairs = [p for d, w in rows if not held(d) for p in zip(["<s>", *w[:-1]], w)]
    count, bi = collections.Counter(w for _, w in pairs), collections.Counter(pairs)
    before = collections.Counter(w for _, w in bi)
    cc = lambda c: [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
    d1, d2 = kn_lm._discounts(*cc(before)), kn_lm._discounts(*cc(bi))
    follow, n = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
    for (v, _), k in bi.items():
        follow[v] += k
        n[v][min(k, 3) - 1] += 1
    rest = sum(d1[min(x, 3)] for x in before.values()) / len(bi)

    def p(v, w):
        low = max(before[w] - d1[min(before[w], 3)], 0) / len(bi) + rest / (len(count) + 1)
        if not follow[v]:
            return low
        return (max(bi[v, w] - d2[min(bi[v, w], 3)], 0) + sum(a * b for a, b in zip(d2[1:], n[v])) * low) / follow[v]

    assert abs(sum(p("the", w) for w in count) + p("the", "\0") - 1) < 1e-9
    total = sum(count.values())
    want = sorted(((d, held(d), len(w), sum(count[x] > 0 for x in w), total) for d, w in rows), key=str)
    got = kn_lm.score_documents(docs).collect()
    assert sorted((tuple(r[:5]) for r in got), key=str) == want
    score = sorted(sum(math.log10(p(v, x)) for v, x in zip(["<s>", *w[:-1]], w)) for _, w in rows)
    base = sorted(sum(math.log10((count[x] + 1) / (total + len(count) + 1)) for x in w) for _, w in rows)
    assert np.allclose(sorted(r.score for r in got), score) and np.allclose(sorted(r.base_score for r in got), base)
    assert kn_lm.score_documents(empty).count() == 0


def test_mixing_targets_and_oracle(docs, empty):
    rows = mixing.mix(docs)[0].collect()
    size = collections.Counter()
    for r in rows:
        size[r.source] += r.size
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(size.values()))
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * share > 3 * size[s]} or free
        for s in over:
            target[s] = min(3.0 * size[s], weight[s] * share)
        if over is free:
            break
        left -= sum(target[s] for s in over)
        free -= over
    for r in rows:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.copies <= 3
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from read_parquet('{docs.inputFiles()[0].rsplit('/', 1)[0].removeprefix('file://')}/*.parquet')")
    want = duck.sql(ORACLE_SQL["op4_mixing"]).fetchall()
    assert sorted((r.doc_id, r.size, r.source_size, r.size * r.copies, r.copies) for r in rows if r.doc_id is not None) == sorted(
        (w[0], w[1], w[2], w[4], w[5]) for w in want if w[0] is not None)
    assert mixing.mixed(docs).count() == sum(r.copies for r in rows) and mixing.mixed(empty).count() == 0


def test_extraction(spark):
    body = "<nav><a href=/>Home</a></nav><div class='ad box'>Buy</div><article><h1>T {0} &amp; more</h1><p>A<b>B</b> {0}<br>c"
    pages = [(i, f"https://h{i % 2}.org/{i}", body.format(i) + "<p>last&nbsp;one<div class=comments><p>me too</p></div></article><footer>f</footer>")
             for i in range(6)]
    pages += [(10, None, "<p>plain {x}"), (11, "https://z.org/a", None), (12, "https://z.org/a", ""), (12, "bad url", "x < y &lt; z"),
              (13, "https://n.org/1", "<div id=m1><p>" + "long text here " * 20 + "</p></div><aside>no</aside><script>if(a<b)</script>"),
              (14, "https://deep.org/", "<div>" * 3000 + "deep" + "</div>" * 3000)]
    out = {(r.page_id, r.url): r for r in wrappers.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert out[3, "https://h1.org/3"].text == "T 3 & more AB 3 c last one"
    assert out[10, None].text == "plain {x}" and out[11, "https://z.org/a"].text == "" and out[12, "bad url"].text == "x < y < z"
    assert out[13, "https://n.org/1"].text == ("long text here " * 20).strip() and out[14, "https://deep.org/"].text == "deep"
    assert all(r.n_chars == len(r.text) for r in out.values())


def test_loose_words_do_not_drop_main_text(spark):
    text = "main words of the page that go on for a while"
    shapes = ["<article class='post category-social'>{}</article>", "<main class='has-sidebar'>{}</main>",
              "<body class='blog has-sidebar'><div>{}</div>", "<article><div style='overflow:hidden'>{}</div></article>",
              "<article><div aria-hidden=false data-id=menu>{}</div></article>", "<article><a href='/hidden-falls'>{}</a></article>",
              "<article><section id=related-work><h2 id=social-history>{}</h2></section></article>", "<div class='post social'><article>{}</article></div>",
              "<form id=aspnet><div class=menu-page>{}</div></form>", "<div class=notice>{}</div><div class=notice></div>"]
    drop = ["<article>{}<div class='x comments'>no</div></article>", "<article>{}<div hidden>no</div></article>",
            "<article>{}<p style='color:red; display: none'>no</p></article>", "<article>{}<div id=sidebar>no</div></article>",
            "<article>{}<ul class=post-related><li><a href=/x>no</a></ul></article>", "<article>{}</article><div class=related><article>no</article></div>"]
    pages = [(i, f"https://s{i}.org/", s.format(text)) for i, s in enumerate(shapes + drop)]
    got = {r.page_id: r.text for r in wrappers.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {i: text for i in range(len(pages))}


@pytest.mark.parametrize("join", [True, False])
def test_main_region_is_chosen_per_page(spark, join):
    text = lambda i: f"main words of page {i} " * (3 + i % 4)
    shapes = ["<html><body><article><p>{}</article><div class=b>{}</div>", "<html><body><div class=content><p>{}</div><div class=b>x{}</div>",
              "<html><body><main><p>{}</main><p>{}", "<html><body><div class=old><table><tr><td>{}</table></div><p>same</p>"]
    urls = ["https://h.org/{}", None, "/relative/{}"]
    pages = [(100 * u + i, url and url.format(i), shapes[i % 4].format(text(i), i)) for u, url in enumerate(urls) for i in range(40)]
    out = wrappers.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5), 0 if join else 1 << 20)
    assert {r.page_id: r.text for r in out.collect()} == {i: text(i % 100).strip() for i, _, _ in pages}


def test_wrapper_alignment():
    page = lambda s: wrappers.fold(wrappers.read_page(s))
    w = wrappers.align(page("<ul><li>a<li>b</ul><p>x</p><i>same</i>"), page("<p>y</p><hr><i>same</i>"))
    assert wrappers.expression(w) == "<> (<ul> (<li> #text)+)? <p> #text (<hr>)? <i> 'same'"


@pytest.mark.parametrize("join", [True, False])
def test_pages_of_the_table(spark, join):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in wrappers.extract_pages(pages, broadcast_max=0 if join else 1 << 20).collect()}
    for r in pages.collect():
        a = r.html.split("<article>", 1)[1].split("</article>")[0]
        a = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", a))
        assert got[r.page_id] == re.sub(r"\s+", " ", html.unescape(a)).strip()


def test_language_held_out_accuracy(spark, docs, empty):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95 and all(0 <= r.score <= 1 for r in rows)
    small = {(r.doc_id, r.lang_pred) for r in langid.identify(docs).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (17, "und")} <= small and langid.identify(empty).count() == 0


def test_language_sample_with_null_and_repeated_ids(spark):
    rng = np.random.default_rng(3)
    say = lambda letters: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(30))
    one = next(i for i in range(1000) if langid.is_training(i, 4, 2))
    rows = [(None, say("abcd"), "aa") for _ in range(300)] + [(i, say("efgh"), "aa") for i in range(900)]
    rows += [(i, say("ijkl"), "bb") for i in range(1000, 1400)] + [(one, say("mnop"), "cc") for _ in range(2000)]
    rows += [(one + 4000, "same text again", "dd")] * 1500
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    out = langid.identify(d, per_lang=50).collect()
    count = collections.Counter(r.lang_pred for r in out)
    assert count == {"aa": 1200, "bb": 400, "cc": 2000, "dd": 1500}
    assert np.mean([r.rejected for r in out if r.doc_id is not None and r.doc_id < 900 and r.lang_pred == "aa"]) < 0.05


def test_quality_rejects_junk_and_keeps_clean(spark, docs, empty):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(d, labels)[0].select("doc_id", "keep", "perplexity").join(labels, "doc_id").collect()
    clean = [r.keep for r in rows if r.quality == 1 and r.toxic == 0]
    junk = [r.keep for r in rows if r.quality == 0]
    assert np.mean(clean) > 0.97 and np.mean(junk) < 0.2
    kept = quality.classify(docs, labels.where("doc_id = -1"))[0].collect()
    assert len(kept) == docs.count() and all(r.keep for r in kept)
    assert quality.classify(empty, labels)[0].count() == 0


def test_quality_thresholds_are_each_languages_own(spark):
    d, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rng, alphabet = np.random.default_rng(5), [chr(c) for c in range(0x4E00, 0x4F00)]
    rare = [(10 ** 6 + i, "".join(rng.choice(alphabet, 300)), lang) for i, lang in enumerate(["zz"] * 30 + ["yy"] * 5 + [None])]
    more = spark.createDataFrame(rare, "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(i, 1, 0) for i, _, lang in rare if lang == "zz"], "doc_id long, quality int, toxic int")
    both, mine = d.select("doc_id", "text", "lang").unionByName(more), labels.select("doc_id", "quality", "toxic").unionByName(marks)
    rows = quality.classify(both, mine)[0].where("doc_id >= 1000000").collect()
    assert len(rows) == 36 and all(r.keep for r in rows)
    assert all((r.threshold is None) == (r.lang != "zz") for r in rows)
    # the thresholds are the quantiles of all trusted rows that are not trained on, also of those beyond the sample
    out = quality.classify(d, labels, max_trusted=30)[0].join(labels, "doc_id").where("quality = 1 and toxic = 0 and lang = 'en'").collect()
    above = [r for r in out if r.perplexity > r.threshold / (1 + 3 / r.n_bytes ** 0.5)]
    assert len(out) > 120 and len(above) <= 0.02 * len(out)


def test_small_sample_quantile():
    assert np.allclose([quality._student(n, 0.99) for n in (1, 2, 10, 48)], [31.8205, 6.9646, 2.7638, 2.4066], rtol=2e-3)


def test_kneser_ney_bytes_sum_to_one():
    text = b"abab abba baab " * 9
    k, n = np.unique(quality.keys_of([text])[0], return_counts=True)
    tables = quality._orders(k, n, 1)
    d = {i: kn_lm._discounts(3, 2, 1, 1).tolist() for i in range(1, 6)}
    ctx = k[:1] & ~np.uint64(0xFF)
    p = quality._interpolate(tables, ctx + np.arange(256, dtype=np.uint64), np.full(256, 1 / 256), 1, d)
    assert abs(p.sum() - 1) < 1e-9


def test_pipeline_against_its_operators(spark):
    """The stages compose: brute-force near duplicates and contamination agree with what the pipeline keeps."""
    from .test_duplicates import brute_components
    docs, folder = spark.read.parquet(f"{SF}/documents.parquet"), corpus_pipeline.store.new_store(spark, "t")
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, corpus_pipeline.store.saved(stage(spark, docs, SF), folder, f"s{i}")
        out.append((before.collect(), docs.collect()))
        if i < 4:
            assert docs.columns == before.columns
    assert {r.doc_id for r in out[1][1]} == {c for _, _, c in brute_components(out[1][0])}
    assert {r.doc_id for r in out[2][1]} <= {r.doc_id for r in out[2][0]}
    tok = Tokenizer.from_file(tokenizer_file())
    ids = [len(tok.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in out[4][0]]
    assert sum(r.n_tokens for r in out[4][1]) == sum(ids) and len(out[4][1]) == len(ids)
