"""The training-data operators on small tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import collections
import hashlib
import html
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.llm import curriculum_mix, decontaminate, html_text, importance, jaccard_join, lm_score, quality_rules, secret_scan, token_counts, warc

random.seed(5)
VOCABULARY = ["".join(random.choices("abcdefgh", k=4)) for _ in range(400)]


def text(n, words=VOCABULARY):
    return " ".join(random.choice(words) for _ in range(n))


BASE = [text(80) for _ in range(12)]
SPECIAL = [None, "", " \n\t ", "one", "one two three four", "ein Wort\x0bmehr", "a b c " * 60, "x " * 3000, "😀 é 日本 " * 9, "q\n\nq\nz\nq", "!!! *** ### |" * 20]
ROWS = [(k, t, random.choice(["a", "b", None]), "l") for k, t in enumerate(BASE + SPECIAL)] + [(3, BASE[3], "a", "l"), (None, BASE[0], "b", "l"), (None, None, None, None)]
SCHEMA = "doc_id long, text string, source string, lang string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def duck(sql, **tables):
    c = duckdb.connect()
    for name, df in tables.items():
        pdf = df.toPandas()
        for k in pdf.columns:
            if k.endswith("_id"):
                pdf[k] = pdf[k].astype("Int64")
        c.register(f"_{name}", pdf)
        casts = ", ".join(f"CAST({k} AS {'BIGINT' if k.endswith('_id') else 'VARCHAR'}) AS {k}" for k in pdf.columns)
        c.sql(f"CREATE TABLE {name} AS SELECT {casts} FROM _{name}")
    rel = c.sql(sql)
    return sorted((tuple(dict(zip(rel.columns, r, strict=True))[k] for k in sorted(rel.columns)) for r in rel.fetchall()), key=repr)


def spark_rows(df):
    return sorted((tuple(r[k] for k in sorted(df.columns)) for r in df.collect()), key=repr)


def test_quality_rules_equal_their_sql(spark, docs, empty):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    clashing = docs.withColumn("n_words", F.lit("clash")).withColumn("kept", F.lit(1))
    got = quality_rules.quality_rules(clashing).select(*names)
    assert spark_rows(got.select(*names)) == duck(f"SELECT {', '.join(names)} FROM ({quality_rules.OP1_SQL})", documents=docs)
    assert quality_rules.quality_rules(empty).count() == 0


def test_repeated_windows_by_brute_force(spark):
    texts = [" ".join(random.choices("ab", k=n)) for n in (0, 2, 3, 4, 9, 30)] + ["a a a a", "a b c x a b c", text(500, VOCABULARY[:12])]
    got = {r["t"]: r["n_repeat_words"] for r in quality_rules.quality_rules(spark.createDataFrame([(t,) for t in texts], "t string"), text_col="t").collect()}
    for t in texts:
        w = t.split()
        seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        assert got[t] == len({j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)})


PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style></head><body><div class="site-header">Top</div><nav><a href=x>menu</a></nav>
<div class="ad">Buy this now because it is very cheap and good for you</div><article><h1>Head &amp; line</h1><p>First  part with
<b>bold</b>ness.<p>Second &lt;b&gt; &eacute;<br>after<ul><li>one<li>two</ul><script>var x = "</p>";</script><form>Mail</form>
<section id="comments"><p>I say</p></section><p>Last</p></article><aside>Side</aside><footer>&copy; 2024</footer></body></html>"""


def test_html_text(spark):
    pages = spark.createDataFrame([(1, "u", PAGE), (2, None, None), (None, "v", ""), (4, "w", "<p>unclosed &am"), (4, "w", "<p>unclosed &am"), (5, "x", "<div>" * 3000 + "deep" + "<p>z" * 50)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r for r in html_text.html_text(pages).collect()}
    assert got[1]["text"] == "Head & line\nFirst part with boldness.\nSecond <b> é\nafter\none\ntwo\nLast" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == "" and got[None]["text"] == "" and got[4]["text"] == "unclosed &am" and got[5]["text"].startswith("deep\nz")
    assert html_text.html_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article><p>Before it all</p><ul>" + "".join(f"<li><a href=x>item {k}</a></li>" for k in range(6)) + "</ul><p>After</p></article>", "Before it all\n" + "\n".join(f"item {k}" for k in range(6)) + "\nAfter"),
        ("<nav><a>menu</a></nav><article><h1><a href=x>Linked headline</a></h1><p>Text</p></article>", "Linked headline\nText"),
        ('<article><p>One</p><div class="social-theory">Two</div><div class="notice-period">Three</div><div class="cookie-notice">No</div></article>', "One\nTwo\nThree"),
        ("<div>" + "<p>" + "long " * 40 + "</p>" * 1 + ("<p>" + "long " * 40 + "</p>") * 4 + '<div class="ad">Buy</div><p>' + "tail " * 20 + "</p></div>", "\n".join(["long " * 39 + "long"] * 5 + ["tail " * 19 + "tail"])),
        ("<article><p>Short</p></article><p>" + "after " * 40 + '</p><p class="siteFooter">Foot</p><p>Top</p>', "Short\n" + "after " * 39 + "after"),
        ("<article><p>a</p><aside>no</aside><p>b</p></article><div>Read more</div>", "a\nb"),
    ],
)
def test_regions_are_decided_by_their_lines(page, want):
    assert html_text.main_text(page) == want


def brute_regions(lines):
    """What surges, by summing every window anew: lines are (text, linked characters, inside)."""
    surge = html_text.BESIDE if any(x[2] for x in lines) else html_text.SURGE
    weight = [len(t) + surge if inside else len(t) - link for t, link, inside in lines]
    window = lambda k: sum(weight[max(0, k - html_text.WINDOW + 1) : k + 1])
    out, k = [], 0
    while k < len(lines):
        if not window(k):
            k += 1
            continue
        end = next((j for j in range(k, len(lines)) if not window(j)), len(lines))
        if max(map(window, range(k, end))) >= surge:
            out += [lines[j][0] for j in range(k, end) if lines[j][0]]
        k = end
    return "\n".join(out) if out else "\n".join(t for t, *_ in lines if t) if sum(weight) else ""


def test_random_pages_by_brute_force():
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcde", k=rng.randint(1, 9)))
    for k in range(400):
        page = []
        for _ in range(rng.randint(0, 25)):
            kind, words = rng.choice(["p", "div", "a", "li", "nav", "aside", "h2", "article", "section"]), " ".join(word() for _ in range(rng.choice([0, 1, 3, 9, 30])))
            page.append(f"<{kind}{rng.choice(['', ' class=ad', ' id=text'])}>{words}" + rng.choice([f"</{kind}>", f"</{kind}>", "", "</div>"]))
        page = "".join(page)
        assert html_text.main_text(page) == brute_regions(html_text.lines_of(page))


def test_stray_closing_tags_take_linear_time():
    import time

    began = time.time()
    assert html_text.main_text("<div>" * 30_000 + "</p>" * 30_000 + "text") == "text"
    assert time.time() - began < 4


def test_html_without_an_article_keeps_what_surges():
    page = '<div id="menu"><a href=a>Home</a></div><div><h2>T</h2><p>' + "word " * 40 + "</p><p>Short.</p><p>" + "more " * 30 + '</p></div><div class="footer-links"><p>' + "foot " * 30 + "</p></div>"
    assert html_text.main_text(page) == "T\n" + ("word " * 40).strip() + "\nShort.\n" + ("more " * 30).strip()
    assert html_text.main_text("<p>tiny</p>") == "tiny"
    assert html.unescape("&amp;") == "&"


def test_secrets_equal_their_sql(spark, empty):
    texts = ['password = "abcdef1" Token:xyz api_key=12345 apikey:\'AB-cd_12\'', "AKIA" + "Q" * 16 + " AKIAAKIA" + "Z" * 14 + " AKIAshort", "é " + "0a" * 12 + " " + "f" * 23, "secret=secret=secret=q", "ghp_Kq81LmNoPwRt5ZyVbXc2 plain", "passwd=ghp_Kq81LmNoPwRt5ZyVbXc2", None, "", "key " * 500]
    rows = [(k, t, f"s{k % 3}", None) for k, t in enumerate(texts)] + [(0, texts[0], "s0", None), (None, texts[1], None, None)] + [(100 + k, "token=exampleval9 token=Zq81LmNoPw", f"o{k}", None) for k in range(5)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied"]
    got = secret_scan.secret_scan(df).select(*names)
    assert spark_rows(got) == duck(secret_scan.OP3_SQL, documents=df)
    by = {r["doc_id"]: r for r in got.collect()}
    assert by[4]["spans"] == "bare:0:24" and by[5]["spans"] == "assign:0:31" and by[7]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert by[100]["n_copied"] == 2  # five owners hold both values
    assert secret_scan.secret_scan(empty).count() == 0


def test_secrets_of_one_owner_are_live_however_often_they_occur(spark):
    rows = [(k, f"token=Zq81LmNoPw text {k}", "hot", None) for k in range(200)] + [(900, "passwd=aB3x9Z", "b", None), (901, "passwd=aaaaaaa1", "b", None)]
    got = {r["doc_id"]: r["n_live"] for r in secret_scan.secret_scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[k] == 1 for k in range(200)) and got[900] == 1 and got[901] == 0


def test_live_secrets_are_replaced_and_copied_ones_stay(spark):
    rows = [(1, "x password=Zq81LmNoPw y", "a", None)] + [(k, "token=Ab12Cd34Ef", f"s{k}", None) for k in range(2, 8)] + [(9, None, "a", None), (1, "x password=Zq81LmNoPw y", "a", None)]
    clashing = spark.createDataFrame(rows, SCHEMA).withColumns({"n_chars": F.length("text").cast("long"), "_live": F.lit("mine"), "_k0": F.lit(1), "_owner": F.lit(2), "_hash": F.lit(3)})
    out = secret_scan.redact_secrets(clashing)
    assert out.columns == clashing.columns and secret_scan.redact_secrets(clashing.limit(0)).count() == 0
    out = out.collect()
    assert {r["_live"] for r in out} == {"mine"}
    one = [r for r in out if r["doc_id"] == 1]
    assert [(r["text"], r["n_chars"]) for r in one] == [("x password=[SECRET] y", 21)] * 2
    assert {r["text"] for r in out if r["source"] and r["source"].startswith("s")} == {"token=Ab12Cd34Ef"} and len(out) == len(rows)


def test_lm_base_by_brute_force(spark, docs, empty):
    got = lm_score.lm_score(docs).collect()
    split = lambda t: (t or "").encode().lower().split() + [b" end"]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    count = collections.Counter(w for d, t, *_ in ROWS if not held(d) for w in split(t))
    total, kinds = sum(count.values()), len(count)
    want = sorted(
        ((d, held(d), len(split(t)), sum(count[w] > 0 for w in split(t)), total, round(sum(math.log10((count[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in split(t)), 6)) for d, t, *_ in ROWS), key=repr
    )
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=repr) == want
    assert all(r["score"] < 0 for r in got)
    assert lm_score.lm_score(empty).count() == 0


def test_lm_levels_are_found_again_by_probing():
    from tracewright.llm.hashing import Bloom, mix, put_keys

    keys, counts = mix(np.arange(1, 3000, dtype=np.uint64)), np.arange(1, 3000)
    held = {}
    put_keys(held, lm_score._expand(keys, counts), 16, lm_score.LOG_PARTS, lm_score.HASHES)
    bits = np.concatenate([held.get(k, np.zeros(1 << 13, np.uint8)) for k in range(1 << lm_score.LOG_PARTS)])
    bloom = Bloom(bits, 16 + lm_score.LOG_PARTS, lm_score.LOG_PARTS, lm_score.HASHES)
    found = lm_score.probe(bloom, keys)
    assert (found >= lm_score.level(counts)).all() and (found == lm_score.level(counts)).mean() > 0.99
    assert (lm_score.probe(bloom, mix(np.arange(10**6, 10**6 + 5000, dtype=np.uint64))) > 0).mean() < 0.01
    ratio = lm_score.MEANS[lm_score.level(counts)] / counts
    assert ratio.min() > 0.6 and ratio.max() < 1.6


def test_lm_filters_grow_with_their_keys_and_are_scored_slice_by_slice(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(k, " ".join(f"w{int(rng.paretovariate(0.6)) % 5000}" for _ in range(400)), "s", None) for k in range(250)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    key = lambda r: r["doc_id"]
    whole = sorted(lm_score.lm_score(df).collect(), key=key)
    monkeypatch.setattr(lm_score, "LOG_LEAST", 3)
    unigrams = lm_score.unigram_filter(lm_score.count_words(df, "text"), 250)
    small, _ = lm_score.bigram_filter(df, "text", 250 * 401, unigrams)
    assert small.log_bits > 3 + lm_score.LOG_PARTS and 0.1 < small.fill < 0.45 and len(small.slices) == 1
    monkeypatch.setattr(lm_score, "LOG_LEAST", 14)
    monkeypatch.setattr(lm_score, "LOG_SLICE", 18)
    cut, _ = lm_score.bigram_filter(df, "text", 250 * 401, unigrams)
    assert len(cut.slices) == 16
    again = sorted(lm_score.lm_score(df).collect(), key=key)
    assert [(r["doc_id"], r["score"]) for r in again] == [(r["doc_id"], r["score"]) for r in whole]
    assert lm_score.log_width(1_200_000_000 >> 13, 14) + 13 >= 33  # bigram keys expected at 30 GB, in 2**13 ranges


def test_lm_filters_pass_the_driver_in_pieces_and_are_probed_in_blocks(spark, monkeypatch):
    rng = random.Random(10)
    df = spark.createDataFrame([(k, " ".join(f"w{rng.randrange(3000)}" for _ in range(200)), "s", None) for k in range(60)], SCHEMA).repartition(3)
    vocabulary = lm_score.count_words(df, "text")
    unigrams = lm_score.unigram_filter(vocabulary, 60)
    want, weight = lm_score.bigram_filter(df, "text", 60 * 201, unigrams)
    keys = [rng.getrandbits(64) for _ in range(500)]
    probed, sizes, has, collect = want.levels(np.array(keys, np.uint64)), [], lm_score.Bloom.has, type(df).collect

    def collected(self):
        rows = collect(self)
        assert sum(len(x) for r in rows for x in r if isinstance(x, bytes | bytearray)) < 1 << 16, "a filter came whole"
        return rows

    monkeypatch.setattr(type(df), "collect", collected)
    monkeypatch.setattr(lm_score, "AT_ONCE", 1 << 13, raising=False)
    monkeypatch.setattr(lm_score, "PROBED", 64, raising=False)
    monkeypatch.setattr(lm_score.Bloom, "has", lambda self, keys: (sizes.append(len(keys)), has(self, keys))[1])
    again, same = lm_score.bigram_filter(df, "text", 60 * 201, lm_score.unigram_filter(vocabulary, 60))
    assert (again.slices[0].value == want.slices[0].value).all() and again.fill == want.fill and (same == weight).all()
    assert (again.levels(np.array(keys, np.uint64)) == probed).all() and max(sizes) <= 64


def test_lm_workers_hold_few_bytes_a_bigram(spark, monkeypatch):
    import tracemalloc

    import pyarrow as pa
    from tracewright.llm import hashing

    rng = random.Random(11)
    rows = [(k, " ".join(f"w{rng.randrange(3000)}" for _ in range(2000)), "s", None) for k in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    monkeypatch.setattr(lm_score, "LOG_SLICE", 20)
    monkeypatch.setattr(lm_score, "PROBED", 1 << 12)
    monkeypatch.setattr(lm_score, "HELD_BIGRAMS", 500_000)
    ran, mapped = {}, type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *a, **k: (ran.update({f.__name__: f}), mapped(self, f, *a, **k))[1])
    lm_score.lm_score(df)
    monkeypatch.setattr(hashing, "CHUNK_ROWS", 2)
    texts = pa.array([r[1] for r in rows])
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([False] * len(rows)), texts], names=["doc_id", "held_out", "_text"])
    peaks = {}
    for name, given in (("run", batch), ("count", pa.RecordBatch.from_arrays([texts], names=["text"]))):
        tracemalloc.start()
        for _ in ran[name](iter([given])):
            pass
        peaks[name] = tracemalloc.get_traced_memory()[1] / (300 * 2001)
        tracemalloc.stop()
    assert peaks["run"] < 25 and peaks["count"] < 35, peaks


def test_lm_workers_give_memory_back_and_pass_bigrams_on_in_pieces(spark, monkeypatch):
    import pathlib
    import subprocess
    import sys

    import pyarrow as pa
    from pyspark import cloudpickle

    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(100_000)}" for _ in range(1000)) for _ in range(300)]
    df = spark.createDataFrame([(k, t, "s", None) for k, t in enumerate(texts)], SCHEMA)
    ran, mapped = [], type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *a, **k: (ran.append(f), mapped(self, f, *a, **k))[1])
    lm_score.lm_score(df)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    count = next(f for f in ran if f.__name__ == "count")
    sizes = [b.nbytes for b in count(iter([batch]))]
    assert len(sizes) == 16 and max(sizes) < sum(sizes) / 12
    given, steps, levels_of = [], [], lm_score.Sliced.levels_of
    monkeypatch.setattr(lm_score, "give_back", lambda: steps.append("give back"), raising=False)
    monkeypatch.setattr(lm_score.Sliced, "levels_of", lambda self, blocks: (steps.append("probe"), levels_of(self, blocks))[1])
    for k in range(2):
        given.append(pa.RecordBatch.from_arrays([pa.array([k]), pa.array([False]), pa.array(texts[k : k + 1])], names=["doc_id", "held_out", "_text"]))
    assert sum(b.num_rows for b in ran[-1](iter(given))) == 2 and steps == ["probe", "give back", "probe"] * 2  # words, then bigrams
    code = """
import pathlib, pickle, random, re, sys
import pyarrow as pa
words = pickle.load(sys.stdin.buffer)
held = lambda: int(re.search("RssAnon:\\s+([0-9]+)", pathlib.Path("/proc/self/status").read_text())[1]) >> 10
def given(n):
    rng = random.Random(5)
    for _ in range(n):
        yield pa.RecordBatch.from_arrays([pa.array([" ".join([f"w{rng.getrandbits(22)}" for _ in range(1000)]) for _ in range(1000)])], names=["text"])
for n in (0, 0, 3):
    before = held()
    assert sum(b.num_rows for b in words(given(n))) == 0 or n
print(held() - before)
"""
    if pathlib.Path("/proc/self/status").exists():  # else not Linux
        kept = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(ran[0]), capture_output=True, check=True, env={"PYTHONPATH": ":".join(sys.path)}).stdout
        assert int(kept) < 90, f"an idle worker keeps {int(kept)} MB"
    assert all(hasattr(f, "__wrapped__") for f in ran)


def brute_scores(rows):
    """The score by exact counts, quantised as the filters quantise them."""
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    split = lambda t: ["<s>", *(t or "").encode().lower().split(), "</s>"]
    train = [split(t) for d, t, *_ in rows if not held(d)]
    words, pairs = collections.Counter(w for t in train for w in t), collections.Counter(p for t in train for p in zip(t, t[1:], strict=False))
    level = lambda c: int(lm_score.level(np.array([c]))[0]) if c else 0
    mean = lambda c: float(lm_score.MEANS[level(c)])
    after, kinds = collections.Counter(), collections.Counter()
    for (a, _), c in pairs.items():
        after[level(words[a])] += c
        kinds[level(words[a])] += 1
    total = sum(words.values()) - words["<s>"]
    below = total + 0.5 * (len(words) - ("<s>" in words) + 1)

    def chance(a, w):
        weight = after[level(words[a])] / (after[level(words[a])] + kinds[level(words[a])]) if words[a] else 0.0
        return weight * min(mean(pairs[a, w]), mean(words[a]), mean(words[w])) / max(mean(words[a]), 1) + (1 - weight) * (mean(words[w]) + 0.5) / below

    return [(d, sum(math.log10(chance(a, w)) for a, w in zip(split(t), split(t)[1:], strict=False))) for d, t, *_ in rows]


def test_lm_scores_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "FILL", 1e-4)  # no n-gram is taken for another
    rng = random.Random(4)
    names = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(names[min(59, int(rng.paretovariate(0.5)))] for _ in range(rng.randint(1, 80))), "s", None) for k in range(120)]
    rows += [(200, None, "s", None), (201, "", "s", None), (None, "w1 w2 never", None, None), (7, rows[7][1], "s", None), (300, "W3 " * 500, "s", None)]
    got = lm_score.lm_score(spark.createDataFrame(rows, SCHEMA).withColumn("tail", F.lit("clash")).withColumn("doc_id_", F.lit(1)).repartition(3))
    found = sorted(((r["doc_id"], r["score"]) for r in got.collect()), key=repr)
    want = sorted(brute_scores(rows), key=repr)
    assert [d for d, _ in found] == [d for d, _ in want]
    assert max(abs(x - y) for (_, x), (_, y) in zip(found, want, strict=True)) < 1e-6


def test_lm_chances_after_a_context_sum_to_one(spark, monkeypatch):
    """Exact levels (base near 1) make the model exact: all words and one unknown after a context have 1 together."""
    monkeypatch.setattr(lm_score, "FILL", 1e-4)
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice("abc") for _ in range(2)), "s", None) for k in (0, 2, 3, 5, 6)]  # counts small enough to be exact
    held = [k for k in range(1000, 1200) if zlib.crc32(str(k).encode()) % 5 == 1]
    rows += [(held[i], f"{x}", "s", None) for i, x in enumerate(("a", "b", "c", "never"))] + [(held[9], None, "s", None)]
    chance = {r["doc_id"]: r["score"] for r in lm_score.lm_score(spark.createDataFrame(rows, SCHEMA)).collect()}
    brute = dict(brute_scores(rows))
    assert all(abs(chance[d] - brute[d]) < 1e-9 for d in chance)


def test_lm_knows_bigrams_seen_once(spark):
    df = spark.createDataFrame([(0, "one two three four", "s", None), (2, "five six", "s", None)], SCHEMA)
    unigrams = lm_score.unigram_filter(lm_score.count_words(df, "text"), 2)
    bloom, weight = lm_score.bigram_filter(df, "text", 8, unigrams)
    from tracewright.llm.hashing import token_hashes

    h = token_hashes([b"two", b"three", b"five"])
    keys = lm_score.truncated(lm_score.bigram_keys(h[:1].repeat(2), h[1:]), 8)
    assert bloom.levels(keys).tolist() == [1, 0] and weight[1] == 0.5  # each context of level 1 has one token and one kind after it


def test_mixing_equals_its_sql_and_meets_its_targets(spark, docs, empty):
    names = ["doc_id", "size", "source_size", "target", "taken", "position", "position_again"]
    got = curriculum_mix.mix(docs)
    assert spark_rows(got.select(*names)) == duck(curriculum_mix.OP5_SQL, documents=docs)
    for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert r["taken"] == math.floor(r["target"])
    assert got.where("taken > 2 * size").count() == 0 and curriculum_mix.mix(empty).count() == 0
    places = [r["position"] for r in got.collect() if r["position"] is not None]
    assert places == sorted(places)


def test_warc_round_trip(spark, tmp_path):
    big = text(3000)
    rows = [(1, "http://a/é\n x", big), (5, None, big), (3, "u", big), (4, "u", "small"), (6, "u", "small"), (7, "u", None), (None, "u", big), (9, "v", "é" * 2500), (9, "v", "é" * 2500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    out = warc.round_trip(pages, f"file://{tmp_path}/w", chunk=700).where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert spark_rows(out) == duck(warc.OP6_SQL, pages=pages.drop("digest"))
    table = warc.read_archives(spark.createDataFrame([(str(p),) for p in (tmp_path / "w").glob("*.warc.gz")], "path string"), f"file://{tmp_path}/w", chunk=700).collect()
    one = sorted((r for r in table if r["page_id"] == 5), key=lambda r: r["chunk"])
    assert b"".join(r["data"] for r in one).decode() == big and max(len(r["data"]) for r in one) <= 700
    assert {r["url"] for r in table if r["page_id"] == 1} == {"http://a/é\n x"}
    assert warc.round_trip(pages.limit(0), f"file://{tmp_path}/none").count() == 0


def test_decontamination_finds_copies_and_paraphrases(spark, empty):
    wide = ["".join(random.choices("abcdefghij", k=6)) for _ in range(4000)]
    text = lambda n: globals()["text"](n, wide)
    items = [(k, text(40) + ". " + text(12) + ".") for k in range(30)] + [(90, None), (91, ""), (92, "too short")]
    swapped = items[2][1].split()
    for k in range(0, len(swapped), 6):
        swapped[k] = "other"
    rows = [(1, text(200) + " " + items[0][1] + " " + text(300), "s", None), (2, items[1][1].upper(), "s", None), (3, text(60) + " " + " ".join(swapped), "s", None), (4, text(500), "s", None), (5, None, "s", None), (6, "", "s", None), (1, items[0][1], "s", None), (None, items[3][1], None, None)]
    rows += [(100 + k, text(300), "s", None) for k in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    got = decontaminate.leaks(df, benchmark)
    assert sorted(((r["doc_id"], r["item_id"]) for r in got.collect()), key=repr) == sorted([(1, 0), (2, 1), (3, 2), (None, 3)], key=repr)
    kept = decontaminate.drop_leaking(df, benchmark)
    assert kept.count() == len(rows) - 5 and kept.columns == df.columns
    assert decontaminate.leaks(empty, benchmark).count() == 0 and decontaminate.leaks(df, benchmark.limit(0)).count() == 0


def test_items_that_a_third_of_all_rows_copy_are_found(spark):
    wide = ["".join(random.choices("klmnopqrst", k=6)) for _ in range(4000)]
    item = text(40, wide) + ". " + text(12, wide) + "."
    copy = text(90, wide) + " " + item + " " + text(90, wide)
    rows = [(k, copy, "s", None) for k in range(40)] + [(100, text(60, wide) + " " + item + " " + text(60, wide), "s", None)] + [(200 + k, text(200, wide), "s", None) for k in range(79)]
    got = decontaminate.leaks(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(1, item), (2, text(50, wide))], "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(k, 1) for k in range(40)] + [(100, 1)]


def test_candidates_reach_down_to_a_low_cosine(spark):
    names = [w.encode() for w in ("".join(random.choices("uvwxyz", k=7)) for _ in range(400))]
    idf = np.full(1 << decontaminate.LOG_CELLS, 2.0, np.float32)
    item = b" ".join(names[:48]).decode()
    index = decontaminate.build_index(spark, [(1, item, None)], idf)
    window = [names[k] if k % 3 == 0 else names[100 + k] for k in range(48)]  # cosine 1 / 3
    low = index.search([b" ".join(window).decode()])
    assert low == []  # a third in common is no leak
    spread = [w for k in range(48) if k % 4 for w in (names[k], names[200 + k], names[250 + k])]  # 36 of 48 words, one in three: cosine 1 / 3 at most
    assert [(d, k) for d, k, *_ in index.search([b" ".join(spread).decode()])] == [(0, 1)]


def test_randomised_svd_equals_the_exact_one(spark):
    from tracewright.llm.hashing import token_hashes

    tokens = np.sort(token_hashes([w.encode() for w in set(VOCABULARY)]))
    rng = np.random.default_rng(0)
    passages = [(np.sort(rng.choice(tokens, 20, replace=False)), rng.random(20)) for _ in range(60)]
    vocabulary, right = decontaminate.randomized_svd(spark, passages, 60)
    dense = np.zeros((60, len(vocabulary)))
    for k, (t, w) in enumerate(passages):
        dense[k, np.searchsorted(vocabulary, t)] = w
    assert np.abs(dense - dense @ right @ right.T).max() < 1e-4


def test_common_subsequences():
    rng = random.Random(1)
    for _ in range(60):
        a, b = [rng.randrange(5) for _ in range(rng.randrange(1, 12))], [rng.randrange(5) for _ in range(rng.randrange(0, 20))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert decontaminate.common_length(a, b) == best[-1][-1]


def brute_components(rows):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, *_) in enumerate(rows)), key=repr)


def test_jaccard_join_by_brute_force(spark, docs, empty):
    rows = list(ROWS)
    family = BASE[1].split()
    for k in range(60):  # near copies, some closer to each other than others
        w = list(family)
        for _ in range(k % 5):
            w[random.randrange(len(w))] = random.choice(VOCABULARY)
        rows.append((200 + k, " ".join(w) + (" " + text(6) if k % 7 == 0 else ""), "a", "l"))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("clash")).repartition(5)
    got = jaccard_join.jaccard_join(df).select("doc_id", "n_shingles", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_components(rows)
    assert jaccard_join.jaccard_join(empty).count() == 0
    kept = jaccard_join.keep_one(df)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == df.columns and {c for d, n, c in brute_components(rows) if n and d is not None} <= set(ids)
    assert len([d for d in ids if d is not None]) == len({(d, c) for d, n, c in brute_components(rows) if d is not None and (d == c)})


def test_a_single_short_text_has_one_shingle(spark):
    for t in ("one", "one two", "one two three", "one two three four"):
        assert len(jaccard_join.shingle_sets([t])[0]) == 1
        assert len(set(map(int, np.concatenate(jaccard_join.set_names(*jaccard_join.shingle_sets([t])))))) == 2
    df = spark.createDataFrame([(1, "one two", "s", None), (2, "one two three", "s", None)], SCHEMA).repartition(2, "doc_id")
    assert sorted((r["doc_id"], r["n_shingles"]) for r in jaccard_join.jaccard_join(df).collect()) == [(1, 1), (2, 1)]


def test_postings_come_out_of_their_blobs_as_they_went_in():
    rng = np.random.default_rng(1)
    for size, top in ((1, 5), (2000, 300), (5000, 1 << 40), (300, 1 << 63)):
        h = np.sort(rng.integers(0, 1 << 53, size, np.uint64)) << np.uint64(11)
        e, n, p = rng.integers(0, top, size, np.uint64), rng.integers(1, 90_000, size), rng.integers(0, 200 if size > 1 else 90_000, size)
        n = np.array([dict(zip(e.tolist(), n.tolist(), strict=True))[x] for x in e.tolist()])  # an entity has one size
        out = jaccard_join._unpack(jaccard_join._pack(h, e, n, p))
        assert all((x == y).all() for x, y in zip(out, (h, e, n, p), strict=True))


def hot_rows():
    """Texts around common passages: copies, near copies that link in chains, others that share much but too little."""
    rng = random.Random(12)
    common = [rng.choice(VOCABULARY) for _ in range(60)]
    rows = []
    for k in range(260):
        w = list(common)
        for _ in range(k % 9):
            w[rng.randrange(60)] = rng.choice(VOCABULARY)
        own = [rng.choice(VOCABULARY) for _ in range((0, 3, 12, 40)[k % 4])]
        rows.append((k, " ".join(w + own), "s", None))
    return rows + [(1000 + k, " ".join(common), "s", None) for k in range(40)]


@pytest.mark.parametrize("hot", [False, True])
def test_hot_shingles_lose_no_link(spark, monkeypatch, hot):
    monkeypatch.setattr(jaccard_join, "SPLIT", 8)  # groups are cut into blocks
    monkeypatch.setattr(jaccard_join, "MOST_BLOCKS", 5)
    if hot:
        monkeypatch.setattr(jaccard_join, "HOT", 20)  # and dealt to sub-groups before
        monkeypatch.setattr(jaccard_join, "SALTS", 7)
    rows = hot_rows()
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, SCHEMA).repartition(4)).select("doc_id", "n_shingles", "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_components(rows)


def test_sets_that_share_a_name_are_told_apart(spark, monkeypatch):
    """All names of sets with as many shingles clash; the second name still tells them apart."""
    real = jaccard_join.set_names

    def clashing(h, n, clashes=None):
        name, other = real(h, n)
        name = np.where(n > 0, np.uint64(77) + (n % 3).astype(np.uint64), np.uint64(0))
        return (np.where(np.isin(name, clashes), other, name) if clashes is not None and len(clashes) else name), other

    rows = [(k, " ".join(random.Random(k // 2).choices(VOCABULARY, k=12)) + (" end" if k % 2 else ""), "s", None) for k in range(8)]
    found = jaccard_join._entities
    spark_rows_ = [(d, int(x), int(y), b"p") for d, (x, y) in enumerate(zip([5, 5, 6, 6], [1, 2, 3, 3], strict=True))]
    table = spark.createDataFrame([(d, 10, x, y, p) for d, x, y, p in spark_rows_], "doc_id long, n long, entity long, other long, print binary")
    renamed, entities, clashes = found(table)
    assert {r["doc_id"]: r["entity"] for r in renamed.collect()} == {0: 1, 1: 2, 2: 6, 3: 6} and clashes.tolist() == [5]
    assert sorted(r["e"] for r in entities.collect()) == [1, 2, 6]
    h, n = jaccard_join.shingle_sets([t for _, t, *_ in rows])
    names, others = clashing(h, n, np.array([77, 78, 79], np.uint64))
    assert (names == others).all() and len(set(names.tolist())) == 8


@pytest.mark.parametrize("most", [0, 1000])
def test_components_of_chains_and_stars(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard_join, "ONE_TASK", most)
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 20)] + [(300, 301)]
    got = dict(map(tuple, jaccard_join.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert all(got[k] == 0 for k in range(1, 41)) and all(got[100 + k] == 100 for k in range(1, 20)) and got[301] == 300


def test_token_counts_equal_the_library(spark, docs, empty):
    P = pytest.importorskip("public_tokenizers")
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=P.path(token_counts.MODEL))
    alphabet = ["a", "the", "▁", " ", "  ", "\n", "\t", "é", "日", "𝒳", "in", "<s>", "<0x0A>", "\x00", "aaaa", "....", "\r\n"]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(3000)] + ["a" * 5000, " " * 5000, "ab" * 3000, "".join(random.choice("abcdefgh") for _ in range(6000)), "Ã"]
    counter = token_counts.PieceCounter(P.path(token_counts.MODEL))
    assert counter.texts(texts) == [len(x) for x in model.encode(texts, num_threads=1)]
    pieces = [x.replace(" ", "▁") for x in texts[:400] if x and "\n" not in x]
    assert counter.counts(pieces).tolist() == [counter._one_by_one(x) for x in pieces]
    got = token_counts.token_counts(docs.withColumn("n_tokens", F.lit("clash")), P.path(token_counts.MODEL)).collect()
    want = [(d, len((t or "").encode()), len(model.encode(t or ""))) for d, t, *_ in ROWS]
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got)
    assert token_counts.token_counts(empty, P.path(token_counts.MODEL)).count() == 0


def test_classifier_on_labels_it_has_not_seen(spark, empty):
    rng = random.Random(3)
    good = lambda: " ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(40, 120)))
    bad = [lambda: " ".join(w + "###" for w in good().split()), lambda: " ".join(rng.choice(VOCABULARY + ["vile"] * 60) for _ in range(90)), lambda: " ".join(w for w in good().split() for _ in range(6)), lambda: good().upper().replace(" ", "!! ")]
    rows, labels = [], []
    for k in range(1600):
        clean = k % 4 != 0
        rows.append((k, good() if clean else bad[k // 4 % 4](), "s", None))
        labels.append((k, int(clean or bad[k // 4 % 4] is bad[1]), int(not clean and bad[k // 4 % 4] is bad[1])))
    shown, hidden = labels[:1000], labels[1000:]
    rows += [(5000, None, "s", None), (5001, " ", "s", None), (None, good(), None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    table = spark.createDataFrame([*shown, (None, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in importance.importance_classifier(df, table).collect()}
    clean = [got[d] for d, q, t in hidden if q and not t]
    junk = [got[d] for d, q, t in hidden if not (q and not t)]
    assert np.mean(clean) > 0.95 and np.mean(junk) < 0.1
    assert not got[5000] and not got[5001] and len(got) == len(rows)
    clashing = df.withColumn("kept", F.lit("mine")).withColumn("log_weight", F.lit(1)).withColumn("_n", F.lit(2)).withColumn("text_hash", F.lit(3))
    good_rows = importance.keep_good(clashing, table)
    assert good_rows.columns == clashing.columns and {r["kept"] for r in good_rows.collect()} == {"mine"}
    assert {r["doc_id"] for r in good_rows.select("doc_id").collect()} == {d for d, k in got.items() if k}
    assert importance.importance_classifier(clashing, table, k=100).where("kept").count() == 100
    assert importance.importance_classifier(empty, table).count() == 0
    unlabelled = importance.importance_classifier(df, table.limit(0))
    assert unlabelled.where("not kept").count() == 2


def brute_ngrams(t):
    """The n-grams of a text as (family, value), by plain Python."""
    raw = (t or "").encode()
    plain = bytes(c + 32 if 65 <= c <= 90 else c if c > 126 or chr(c).isalnum() else 32 for c in raw).split()
    signs = bytes(c if 32 < c < 127 and not chr(c).isalnum() else 32 for c in raw).split()
    out = []
    for k, row in ((0, plain), (2, signs)):
        out += [(k, w) for w in row] + [(k + 1, "again" if k == 0 and p[0] == p[1] else p) for p in zip(row, row[1:], strict=False)]
    for w in plain:
        for k, n in enumerate(importance.INSIDE):
            marked = [None, *w, None]
            out += [(4 + k, tuple(marked[i : i + n])) for i in range(len(marked) - n + 1)]
    return out


def test_log_weights_by_brute_force(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(VOCABULARY[:40] + ["x!!", "é,", "###", "Ünder-score"]) for _ in range(rng.randint(0, 60))) for _ in range(300)] + [None, "", "one", "a" * 3000]
    rows = [(k, t, "s", None) for k, t in enumerate(texts)]
    labels = [(k, int("###" not in (t or "")), 0) for k, t in enumerate(texts) if t]
    df, table = spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    part = {r["_id"]: r["_part"] for r in importance.labelled_sample(table).collect() if r["_good"]}
    raw, target = collections.Counter(), collections.Counter()
    for k, t in enumerate(texts):
        raw.update(brute_ngrams(t))
        if part.get(k, 0) > 0:
            target.update(brute_ngrams(t))
    share = sum(target.values()) / sum(raw.values())

    def ratio(g):
        expected = raw[g] * share
        sure = expected >= importance.LEAST and abs(expected - target[g]) >= importance.SIGMA * math.sqrt(expected)
        return math.log((target[g] + importance.SMOOTH) / (expected + importance.SMOOTH)) if sure else 0.0

    want = {k: importance.PER * sum(map(ratio, brute_ngrams(t))) / max(1, len(brute_ngrams(t))) for k, t in enumerate(texts)}
    got = {r["doc_id"]: r["log_weight"] for r in importance.importance_classifier(df, table).collect()}
    near = [abs(got[k] - want[k]) <= 0.02 * abs(want[k]) + 1 for k in want]
    assert np.mean(near) > 0.98  # two n-grams may share a bucket


def test_top_k_cut_is_the_kth_largest(spark):
    values = [random.gauss(0, 30) for _ in range(500)] + [1.5] * 10
    df = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 7, 250, 505):
        assert abs(importance.top_k_cut(df, "key", k) - sorted(values, reverse=True)[k - 1]) < 1e-6


def test_word_pattern_is_ascii_space():
    assert re.split(r"[\x20\x09-\x0D]+", "a\x0b\x85b c") == ["a", "\x85b", "c"] == [x.decode() for x in "a\x0b\x85b c".encode().split()]
