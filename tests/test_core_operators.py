"""Core operators on small hand-made cases."""

import difflib
import json
import math
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomtable.functions import text as X
from loomtable.models import growth, irt, kmeans, mixed, sem
from loomtable.operators import dedup, extract, facts, merge, resolve, rules, skew, windows
from loomtable.sources import files
from loomtable.streaming import incremental


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, want",
    [("あ。い！う", ["あ。", "い！", "う"]), ("a. b.\nc", ["a.", "b.", "c"]), ("", []), (" 。。x", ["。。", "x"]), (None, None)],
)
def test_sentences(spark, text, want):
    assert one(spark, X.sentences(F.col("t")), t=text) == want


def test_text_functions(spark):
    t = F.col("t")
    assert one(spark, X.cut_at_mark(t, 5, 3), t="あい。うえおか") == "あい。うえ…"
    assert one(spark, X.cut_at_mark(t, 5, 1), t="あいう。えおか") == "あいう。"
    assert one(spark, X.summary(t, 5, 2, False), t="あいう、えおか") == "あいう"
    assert one(spark, X.around(t, "x", 2, 1), t="abxcd") == "abxc"
    assert one(spark, X.around(t, "z", 2, 1), t="abxcd") is None
    assert one(spark, X.number_in(t), t="計1,234.5円") == 1234.5
    assert one(spark, X.number_in(t), t="なし") is None
    assert one(spark, X.year_in(t), t="昭和3年") == 1928
    assert one(spark, X.slug(t), t="https://a.example/x/y-z.html?q=1") == "x_y_z"
    assert one(spark, X.slug(t), t="https://a.example") == "index"
    assert one(spark, X.packed_lines(X.sentences(t), 6), t="あい。うえ。おかき。く。") == ["あい。うえ。", "おかき。く。"]
    assert one(spark, X.nfkc(t), t="ｱＡ①") == "アA1"
    assert one(spark, X.strip_html(t), t="<p>a<script>x<y</script>&amp;<b>b</b></p>") == "a b"
    assert one(spark, X.days_and_nights(t), t="2泊の旅") == 3


def test_votes_and_gates(spark):
    table = [("a", "x"), ("b", "y"), ("b", "z")]
    v = lambda given, text: tuple(one(spark, rules.voted(F.col("g"), F.col("t"), table), g=given, t=text))
    assert v("a", "nothing") == ("a", "kept")
    assert v("a", "x") == ("a", "confirmed")
    assert v("a", "y") == ("a", "ambiguous")
    assert v("a", "y z") == ("b", "reclassified")
    assert v("a", None) == ("a", "kept")
    assert one(spark, rules.gated([F.length("t"), F.lit(0), F.lit(5)]), t="abc") == 0
    assert one(spark, rules.ranked({"p": F.lit(1), "q": F.lit(3), "r": F.lit(3)}), t="") == ["q", "r", "p"]
    assert one(spark, rules.masked(F.col("t"), [("[0-9]+", "<n>"), ("q", "<q>")]), t="a12") == ("a<n>", ["<n>"])
    found = rules.issues([("a", "critical", "t", F.col("t").isNull()), ("b", "info", "t", F.length("t") < 3)])
    assert one(spark, rules.status_of(found), t=None) == "rejected"
    assert one(spark, rules.status_of(found), t="ab") == "flagged"
    assert one(spark, rules.status_of(found), t="abc") == "approved"


def test_even_ranges_match_ntile(spark):
    for n in (1, 6, 7, 20):
        got = [r.bucket for r in windows.even_ranges(spark.range(20).withColumnRenamed("id", "k"), "k", n).orderBy("k").collect()]
        sizes = [20 // n + (i < 20 % n) for i in range(n)]
        assert got == [i + 1 for i, s in enumerate(sizes) for _ in range(s)]


def test_numbers_are_consecutive(spark):
    rows = merge.numbered(spark.range(500).select((F.col("id") * 37 % 500).alias("k")).repartition(7), ["k"], "n", 10).collect()
    assert sorted((r.k, r.n) for r in rows) == [(k, k + 11) for k in range(500)]


def test_places_in_wide_frames_that_are_written_and_read(spark, tmp_path):
    n = 400_000
    wide = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 10).alias("body"))
    merge.numbered(wide, ["k"], "n").write.parquet(str(tmp_path / "numbered"))
    got = spark.read.parquet(str(tmp_path / "numbered")).agg(F.count("*").alias("rows"), F.count_distinct("n").alias("ids"), F.max("n").alias("top"), F.count_if(F.col("n") != F.col("k") + 1).alias("wrong")).first()
    assert tuple(got) == (n, n, n, 0)
    windows.even_ranges(wide, "k", 7).write.parquet(str(tmp_path / "ranges"))
    sizes = spark.read.parquet(str(tmp_path / "ranges")).groupBy("bucket").agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).orderBy("bucket").collect()
    assert [r.n for r in sizes] == [n // 7 + (i < n % 7) for i in range(7)]
    assert all(a.high + 1 == b.low for a, b in zip(sizes, sizes[1:]))


def test_a_cluster_must_name_its_checkpoint_folder(spark, monkeypatch):
    from loomtable import session

    df, context = spark.range(3), spark.sparkContext
    monkeypatch.setattr(context, "getCheckpointDir", lambda: None)
    monkeypatch.setattr(session, "named_folder", lambda s: None)
    monkeypatch.setattr(context, "master", "spark://host:7077")
    with pytest.raises(RuntimeError):
        session.cut_lineage(df)
    monkeypatch.setattr(context, "master", "local[4]")
    assert session.cut_lineage(df).count() == 3


def test_ids_past_the_width_stay_whole(spark):
    old = spark.createDataFrame([("x_999998",)], "id string")
    got = merge.next_ids(spark.range(4).withColumnRenamed("id", "k"), old, "id", ["k"], "x_", 6).orderBy("k").collect()
    assert [r.id for r in got] == ["x_999999", "x_1000000", "x_1000001", "x_1000002"]
    assert merge.next_ids(spark.range(0).withColumnRenamed("id", "k"), old, "id", ["k"], "x_", 6).count() == 0


def test_order_statistics(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([None, 1.0, 2.5, rng.random()]), float(rng.randint(0, 5))) for _ in range(500)] + [("empty", None, None), ("one", 3.0, 4.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    for by, groups in (([], [None]), (["g"], ["a", "b", None, "empty", "one"])):
        got = windows.order_statistics(df, ["x", "y"], [0.0, 0.5, 0.9, 1.0], by).collect()
        assert len(got) == len(groups)
        for r in got:
            for at, c in ((1, "x"), (2, "y")):
                values = [v[at] for v in rows if v[at] is not None and (not by or v[0] == r.g)]
                for k, share in enumerate((0.0, 0.5, 0.9, 1.0)):
                    assert r[f"{c}_{k}"] == (pytest.approx(np.quantile(values, share)) if values else None)


def test_find_or_create_is_that_of_asking_row_by_row(spark):
    rng = random.Random(6)
    for _ in range(3):
        some = lambda letters: rng.choice([*letters, None, " "])
        stored = [(f"s_{i:03}", some("uvw"), some("abc")) for i in range(1, 5)]
        asked = [(i, some("uvwxyz"), some("abcdef")) for i in range(60)]
        held = [(i, (u or "").strip() or None, (t or "").strip() or "(no title)") for i, u, t in stored]
        want, made = {}, set()
        for k, u, t in asked:
            u, t = (u or "").strip() or None, (t or "").strip() or "(no title)"
            hit = min((i for i, v, _ in held if u and v == u), default=None) or min((i for i, v, s in held if v is None and s == t), default=None)
            if hit is None:
                hit = f"s_{len(held) + 1:03}"
                held.append((hit, u, t))
                made.add(hit)
            want[k] = (hit, hit in made)
        s = spark.createDataFrame(stored, "id string, url string, title string")
        a = spark.createDataFrame(asked, "k bigint, url string, title string")
        assert {r.k: (r.source_id, r.is_new) for r in merge.find_or_create(a, s, "k", "s_", 3).collect()} == want


def test_merges(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (None, "z")], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (None, "n"), (3, "c"), (3, "d")], "k int, v string")
    as_set = lambda df: sorted(((r.k, r.v) for r in df.collect()), key=str)
    assert as_set(merge.upsert(old, new, ["k"], ["v"])) == sorted([(1, "a"), (2, "b"), (None, "n"), (3, "d")], key=str)
    assert as_set(merge.insert_absent(old, new, ["k"], ["v"])) == sorted([(1, "a"), (2, None), (None, "z"), (3, "c")], key=str)
    assert as_set(merge.fill_missing(old, new.filter("k = 2"), "k", "v")) == sorted([(1, "a"), (2, "b"), (None, "z")], key=str)
    assert as_set(merge.replace_keys(old, new, ["k"])) == sorted([(1, "a"), (2, "b"), (None, "n"), (3, "c"), (3, "d")], key=str)


def test_new_rows_of_a_batch(spark):
    stored = spark.createDataFrame([("a",), (None,)], "k string")
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, n int")
    assert [(r.k, r.n) for r in dedup.new_rows(batch, stored, ["k"], ["n"]).collect()] == [("b", 2)]


def test_similar_rows_are_found(spark):
    base = "".join(chr(0x3042 + (i * 7) % 60) for i in range(120))
    rows = [(1, "g", base), (2, "g", base), (3, "g", base[:60] + "x" + base[61:]), (4, "g", base[::-1]), (5, "h", base), (6, "g", None), (7, "g", base[:80])]
    df = spark.createDataFrame(rows, "id bigint, grp string, text string")
    got = {r.id for r in dedup.mark_similar(df, "grp", "id", "text").collect()}
    assert difflib.SequenceMatcher(None, base, rows[2][2]).ratio() >= 0.95
    assert got == {2, 3}


@pytest.mark.parametrize("least", [0.95, 0.8, 0.7])
def test_no_similar_pair_is_missed(spark, least):
    rng = random.Random(int(least * 100))
    some = ["".join(rng.choice("abcdef") for _ in range(rng.randint(4, 60))) for _ in range(25)]
    texts = list(some)
    for t in some * 2:  # copies with letters put in, taken out and changed
        for _ in range(rng.randint(1, max(1, len(t) // 8))):
            k = rng.randint(0, len(t))
            t = rng.choice([t[:k] + rng.choice("abcdef") + t[k:], t[:k] + t[k + 1 :], t[:k] + rng.choice("xyz") + t[k + 1 :]])
        texts.append(t)
    rows = [(i, rng.choice(["g", "g", "h", None]), t) for i, t in enumerate(texts)]
    want = set()
    for i, (_, h, b) in enumerate(rows):
        for j, (_, g, a) in enumerate(rows[:i]):
            if g == h and abs(len(a) - len(b)) <= 0.5 * min(len(a), len(b)) and difflib.SequenceMatcher(None, a, b).ratio() >= least:
                want.add(i if len(b) <= len(a) else j)
    assert len(want) > 4
    assert {r.id for r in dedup.mark_similar(spark.createDataFrame(rows, "id bigint, grp string, text string"), "grp", "id", "text", least).collect()} == want


def test_similar_rows_of_one_group(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(60)) for _ in range(14)]
    texts += [t[:30] + "z" + t[31:] for t in texts[:6]] + [t + "q" for t in texts[6:9]]
    df = spark.createDataFrame([(i, "g", t) for i, t in enumerate(texts)], "id bigint, grp string, text string")
    want = set()
    for i, b in enumerate(texts):
        for j, a in enumerate(texts[:i]):
            if difflib.SequenceMatcher(None, a, b).ratio() >= 0.95:
                want.add(i if len(b) <= len(a) else j)
    assert len(want) == 9
    assert {r.id for r in dedup.mark_similar(df, "grp", "id", "text").collect()} == want


def test_few_pairs_are_compared(spark, monkeypatch):
    """Texts of one group that share all their phrases, in some order, are not compared unless they are near copies."""
    rng = random.Random(12)
    words = ["".join(chr(0x4E00 + rng.randrange(600)) for _ in range(6)) for _ in range(60)]
    texts = ["".join(f"{rng.choice(words)}を{rng.choice(words)}と考えます。" for _ in range(rng.randint(4, 12))) for _ in range(300)]
    copies = [t[:30] + "々" + t[31:] for t in texts[:10]] + [t[:20] + t[21:] for t in texts[10:15]] + texts[15:20]
    n, compare = spark.sparkContext.accumulator(0), dedup._compared

    def counted(least, guard):
        inner = compare(least, guard)

        def run(batches):
            def seen():
                for batch in batches:
                    n.add(batch.num_rows)
                    yield batch

            yield from inner(seen())

        return run

    monkeypatch.setattr(dedup, "_compared", counted)
    df = spark.createDataFrame([(i, "g", t) for i, t in enumerate(texts + copies)], "id bigint, grp string, text string")
    got = {(r.id, r.kept_id) for r in dedup.mark_similar(df, "grp", "id", "text").collect()}
    assert got == {(300 + k, k) for k in range(20)}
    assert n.value <= 30


def test_longest_common_subsequence():
    rng = random.Random(14)
    for _ in range(200):
        x, y = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 12))) for _ in range(2))
        row = [0] * (len(y) + 1)
        for c in x:
            new = [0]
            for k, d in enumerate(y):
                new.append(row[k] + 1 if c == d else max(row[k + 1], new[k]))
            row = new
        assert dedup._in_turn(x, y) == row[-1]


def test_similar_rows_of_many_tiles(spark, monkeypatch):
    """Tiles and Arrow batches of a few rows each give the pairs of brute force."""
    rng = random.Random(13)
    letters = "abcdefgh学校の心𠮷"
    some = ["".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 9, 21, 40, 42, 80, 84]))) for _ in range(50)] + ["a" * 700 + "b" * 300, "a" * 690 + "b" * 310, "b" * 700 + "a" * 300]
    texts = some + [t[:5] + rng.choice(letters) + t[5 + rng.randint(0, 1) :] for t in some + some]
    rows = [(i, rng.choice(["g", "g", "g", "", None]), t) for i, t in enumerate(texts)]
    want = {}
    for b, h, y in rows:
        for a, g, x in rows[:b]:
            if g == h and x == y:
                want.setdefault(b, a)
    first = [r for r in rows if r[0] not in want]
    for k, (b, h, y) in enumerate(first):
        for a, g, x in first[:k]:
            if g == h and difflib.SequenceMatcher(None, x, y).ratio() >= 0.95:
                i, kept = (b, a) if len(y) <= len(x) else (a, b)
                want[i] = min(kept, want.get(i, kept))
    assert len(want) > 30
    monkeypatch.setattr(dedup, "TILE", 5)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        df = spark.createDataFrame([*rows, (900, "g", None), (None, "g", some[-1])], "id bigint, grp string, text string")
        assert {r.id: r.kept_id for r in dedup.mark_similar(df, "grp", "id", "text").collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_contained_heads(spark):
    rows = [(1, "g", "abcdef"), (2, "g", "abc"), (3, "g", "abcdef"), (4, "g", "xbc"), (5, "h", "abc"), (6, "g", None), (7, "g", "abcdefgh")]
    df = spark.createDataFrame(rows, "id bigint, grp string, text string")
    want = {b for a, g, s in rows for b, h, t in rows if a < b and g == h and s and t and (s[:5].startswith(t[:5]) or t[:5].startswith(s[:5]))}
    assert {r.id for r in dedup.contained_heads(df, "grp", "id", "text", 5).collect()} == want


def test_contained_heads_anywhere_in_the_text(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["g", "g", "h", None]), "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))) for i in range(120)]
    long = "".join(rng.choice("abcdefgh") for _ in range(90))
    rows += [(200, "l", long), (201, "l", "z" * 37 + long[:80] + "y"), (202, "l", "y" + long[:79]), (203, "l", long[9:60]), (204, "l", None), (205, "m", long)]
    df = spark.createDataFrame(rows, "id bigint, grp string, text string")
    for n in (5, 80):
        want = {b for a, g, s in rows for b, h, t in rows if a < b and g == h and s and t and (s[:n] in t or t[:n] in s)}
        assert {r.id for r in dedup.contained_heads(df, "grp", "id", "text", n).collect()} == want
    assert {201, 203} <= want and not {202, 205} & want


def test_names_in_texts_against_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))) for i in range(60)] + [(99, None)]
    names = ["ab", "abc", "cc", "bab", "a", "zzzz"]
    t = spark.createDataFrame(texts, "k bigint, text string")
    n = spark.createDataFrame([(x,) for x in names + ["ab"]], "name string")
    want = sorted((k, x, s.index(x) + 1) for k, s in texts if s for x in names if len(x) >= 2 and x in s)
    for most in (resolve.AUTOMATON_NAMES, 0):  # as an automaton, and as stretches
        monkeypatch.setattr(resolve, "AUTOMATON_NAMES", most)
        assert sorted((r.key, r.name, r["at"]) for r in resolve.names_in_texts(t, "k", "text", n, "name").collect()) == want
    monkeypatch.setitem(sys.modules, "ahocorasick", None)
    assert sorted((s[e - len(x) + 1 : e + 1], e) for s in ["abcc"] for e, x in resolve._automaton("d", ("ab", "cc", "c"))(s)) == [("ab", 1), ("c", 2), ("c", 3), ("cc", 3)]
    assert resolve.names_in_texts(t, "k", "text", n.limit(0), "name").count() == 0


def test_join_with_few_rows_of_a_key(spark):
    rows = spark.range(200).select("id", (F.col("id") % 3).alias("k"))
    few = spark.createDataFrame([(0, "a"), (2, "c"), (2, "d")], "k bigint, v string")
    for how in ("inner", "left", "left_semi"):
        want = sorted(map(tuple, rows.join(few, "k", how).collect()), key=str)
        for most in (100, 0):
            assert sorted(map(tuple, skew.join_few(rows, few, ["k"], "id", how, most).collect()), key=str) == want


def test_resolver_tiers(spark):
    schools = spark.createDataFrame([("1", "蒼森学園中学校"), ("2", "蒼森学園"), ("3", "琥原中学校")], "id string, name string")
    asked = spark.createDataFrame([(1, "蒼森学園中学校"), (2, "琥原"), (3, "なし、蒼森学園"), (4, "蒼森学園高等学校"), (5, "無い")], "k bigint, name string")
    got = {r.key: (r.entity, r.tier) for r in resolve.resolve_names(asked, "k", "name", schools, "id", "name", ["中学校", "高等学校"]).collect()}
    assert got == {1: ("1", 1), 2: ("3", 2), 3: ("2", 1), 4: ("1", 2)}


def test_resolver_meets_names_inside_names(spark):
    schools = spark.createDataFrame([("1", "汐台義塾中学校"), ("2", "台義塾中学校"), ("3", "旧榛丘学院中等部"), ("4", "汐台義塾中学校")], "id string, name string")
    asked = spark.createDataFrame([(1, "私立汐台義塾中学校"), (2, "榛丘学院"), (3, "榛丘学院中学校"), (4, "無い"), (5, "旧制、榛丘学院中等"), (6, None)], "k bigint, name string")
    got = {r.key: (r.entity, r.tier) for r in resolve.resolve_names(asked, "k", "name", schools, "id", "name", ["中学校", "中等部"]).collect()}
    assert got == {1: ("4", 3), 2: ("3", 3), 3: ("3", 3), 5: ("3", 3)}


def test_blocks_of_a_page():
    html = "<body><nav><p>menu</p></nav><h2>挨拶</h2><p>一<br>二</p><dl><dt>問</dt><dd>答&amp;え</dd></dl><p>開いたまま<script>x='<p>'</script></body>"
    assert extract.parse_blocks(html) == [(0, "p", "挨拶", "一 二"), (1, "dd", "問", "答&え"), (2, "p", "問", "開いたまま")]
    assert extract.parse_blocks("") == [] and extract.parse_blocks("<<<>") is not None


def test_main_region_and_answers_of_varied_pages():
    page = """<body class="x"><div id="gnav"><p>menu</p></div><header><h2>head</h2></header>
    <div class="article-body"><h2>質問</h2><!-- c --><img src=a><p>一<b>つ</b>目<p>二つ目<div>三<div>四</div></div><h3>見出し</h3><h3>次</h3><blockquote><p>引用</p></blockquote>
    <dl><dt>問<dd>答一<dd>答二</dl><script>var p = "<p>no</p>";</script></div><p>outside</p></body>"""
    assert extract.parse_main_texts(page) == [(0, "p", "一つ目"), (1, "p", "二つ目"), (2, "div", "四"), (3, "p", "引用"), (4, "dd", "答一"), (5, "dd", "答二")]
    assert extract.parse_answers(page) == [(0, "heading", "質問", "一つ目"), (1, "heading", "次", "引用"), (2, "quotation", "", "引用"), (3, "definition", "問", "答一"), (4, "definition", "問", "答二")]
    for broken in ("", "<<<>", "</p></div>", "<p", "<div>" * 3000):
        assert extract.parse_main_texts(broken) is not None and extract.parse_answers(broken) == []


@pytest.mark.parametrize("base, link", [(b, x) for b in ("https://a.example/x/y/z.html?q=1#f", "http://a.example", "https://a.example/x/") for x in ("p.html", "/p/q", "../p", "../../p", "./p#t", "//b.example/p", "?n=2", "https://c.example/p#x", "p/../q", "mailto:x@y", "javascript:void(0)")])
def test_links_as_seen_from_a_page(spark, base, link):
    from urllib.parse import urldefrag, urljoin

    want = urldefrag(urljoin(base, link))[0]
    got = one(spark, facts.absolute_url(F.col("b"), F.col("x")), b=base, x=link)
    assert got == (want if want.startswith("http") else None)


def test_facts_of_odd_texts(spark):
    texts = [None, "", "募集は3名。", "特待生入試の募集人員 1,200 名。\n受験者は9999人、合格者は12人、倍率は99.9倍", "検定料 22,000 円、国語50分、国語60分"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, body string")
    got = sorted(((r.id, r.kind, r.exam_type, r.applicants, r.admitted, r.ratio, r.details) for r in facts.admission_facts(df, "id", "body", [("特別", "特待")]).collect()), key=str)
    assert got == [(3, "quota", "特別", None, 1200, None, None), (3, "results", "一般", None, 12, None, None), (4, "details", "一般", None, None, None, '{"subjects":[{"subject":"国語","minutes":50}],"fee":22000}')]
    assert facts.facilities(df, "id", "body", [("a", "x")], "y").count() == 0 and facts.destinations(df, "id", "body", [("a", "b", "x")]).count() == 0


def test_linked_data_markdown_wiki_and_values():
    page = '<script type="application/ld+json">{"@graph":[{"@type":"Review","author":{"name":"n"},"reviewBody":"b"},{"@type":"Question","name":"q","acceptedAnswer":{"text":"a"}}]}</script><script type="application/ld+json">{broken</script>'
    assert extract.parse_linked_data(page) == [("Review", "n", "b"), ("Question", "q", "a")]
    md = "# S1\n### #3 theme\n- speaker: A\n- speaker: B\n> say\n> it\n# S2\n### #1\nquote: x y\n### #2\nnothing\n"
    assert extract.parse_statements(md) == [("S1", 3, "A", "theme", "", "say it"), ("S2", 1, "", "", "", "x y")]
    wiki = "== 人物 ==\n=== 学者 ===\n* [[甲|甲野]] - 物理{{x}}\n* 乙\n== 他 ==\n* [[丙]]（作家）"
    assert extract.parse_wiki(wiki) == [(0, 3, "人物 / 学者", "甲野", "物理"), (1, 3, "人物 / 学者", "", "乙"), (2, 2, "他", "丙", "作家")]
    assert extract.parse_events("4月\n入学式\n（講堂）\n5月 遠足、運動会") == [(4, "入学式", "講堂"), (5, "遠足", ""), (5, "運動会", "")]
    assert extract.parse_values("INSERT INTO t VALUES (1, 'it''s (a), b', NULL), (2,'NULL',f(1,2));") == [(0, 0, "1"), (0, 1, "it's (a), b"), (0, 2, None), (1, 0, "2"), (1, 1, "NULL"), (1, 2, "f(1,2)")]
    for codec in ("utf-8", "cp932", "euc_jp"):
        assert "日本語" in extract.decode_page(f'<meta charset="{codec}">日本語'.encode(codec))
    assert extract.decode_page(None) is None and extract.decode_page(b"\xff\xfe\x00") is not None


def test_parsers_pass_over_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<p>x</p>")], "pos bigint, html string")
    assert [tuple(r) for r in extract.blocks(df.withColumnRenamed("pos", "id"), "id", "html").collect()] == [(3, 0, "p", "", "x")]
    assert extract.wiki_items(df.limit(0), "pos", "html").count() == 0


def test_files_in_and_out(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "t": "あ"}\n\n{broken\n{"id": 2}\n', encoding="utf-8")
    rows = files.json_lines(spark, str(tmp_path / "a.jsonl"), "id bigint, t string").collect()
    assert sorted((r.id or 0, r.t, r.problem) for r in rows if r.problem is None) == [(1, "あ", None), (2, None, None)]
    assert [r.problem for r in rows if r.problem] == ["{broken"]
    (tmp_path / "pages/s1").mkdir(parents=True)
    (tmp_path / "pages/s1/top.html").write_bytes('<meta charset="Shift_JIS">日本'.encode("cp932"))
    (tmp_path / "pages/s1/part.html").write_text("<h1>x</h1>\n<section id='a'>\n本文\n二行</section>", encoding="utf-8")
    assert {(r.entity, r.slug): "日本" in r.html for r in files.pages(spark, str(tmp_path / "pages"), "s").collect()} == {("s1", "top"): True, ("s1", "part"): False}
    assert [(r.pos, r.body) for r in files.sections(spark, str(tmp_path / "pages"), ["part.html"]).collect()] == [(0, "\n本文\n二行")]
    (tmp_path / "prog").mkdir()
    (tmp_path / "prog/a.json").write_text('{"task_id": "x", "status": "old", "count": 1}')
    (tmp_path / "prog/b.json").write_text('{"task_id": "x", "status": "new", "count": 2}')
    (tmp_path / "prog/c.json").write_text('{"status": "own"}')
    assert {r.task: r.status for r in files.progress_files(spark, str(tmp_path / "prog")).collect()} == {"x": "new", "c": "own"}
    (tmp_path / "doc.json").write_text('{"a": {"b": [1, 2]}}')
    assert files.json_documents(spark, str(tmp_path / "doc.json")).first().a.b == [1, 2]
    numbered = files.json_lines(spark, str(tmp_path / "a.jsonl"), "id bigint, t string", numbers=True).collect()
    assert sorted((r.line, r.problem) for r in numbered) == [(1, None), (3, "{broken"), (4, None)]
    cube = spark.createDataFrame([("a", "x", "", None, 1.0), ("a", "w", "", "t", None), ("b", "y", "z", None, 2.0)], "section string, k1 string, k2 string, text string, number double")
    files.write_cube(cube, str(tmp_path / "cube"), "X")
    (script,) = [x for p in (tmp_path / "cube").glob("*.txt") for x in p.read_text().splitlines()]
    assert script.startswith("window.X = {") and [x["k1"] for x in json.loads(script[11:-1])["a"]] == ["w", "x"]
    with pytest.raises(ValueError):
        files.write_cube(cube, str(tmp_path / "none"), "X", most_rows=2)
    files.write_cube(cube, str(tmp_path / "none"), "X", dry_run=True)
    assert not (tmp_path / "none").exists()
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    files.write_json_lines(df, str(tmp_path / "out"))
    files.write_json_lines(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    files.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 2
    files.write_script(df, str(tmp_path / "js"), "D")
    assert all(r.value.startswith("window.D = ") for r in spark.read.text(str(tmp_path / "js")).collect())
    assert [json.loads(r.json) for r in files.report(df).collect()] == [{"a": 1, "b": "x"}, {"a": 2, "b": None}]


def test_streams(spark, tmp_path):
    schema = "id int, key string, at timestamp"
    source, target = str(tmp_path / "in"), str(tmp_path / "table")
    write = lambda rows: spark.createDataFrame(rows, "id int, key string, at string").selectExpr("id", "key", "timestamp(at) at").coalesce(1).write.mode("append").parquet(source)
    write([(1, "a", "2024-01-01 00:10:00"), (2, "a", "2024-01-01 00:20:00"), (3, "b", "2024-01-01 01:10:00")])
    stream = spark.readStream.schema(schema).parquet(source)
    incremental.append_new(stream, target, ["key"], ["id"], str(tmp_path / "cp")).awaitTermination()
    write([(4, "b", "2024-01-01 05:00:00"), (5, "c", "2024-01-01 09:00:00")])
    incremental.append_new(stream, target, ["key"], ["id"], str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.id, r.key) for r in spark.read.parquet(target).collect()) == [(1, "a"), (3, "b"), (5, "c")]
    for k, (frame, n) in enumerate([(incremental.windowed_counts(stream, "at", "key"), 3), (incremental.session_counts(stream, "at", "key"), 3)]):
        frame.writeStream.format("memory").queryName(f"q{k}").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / f"c{k}")).start().awaitTermination()
        assert spark.table(f"q{k}").count() == n
    q = incremental.first_seen(stream, "at", ["key"]).writeStream.format("memory").queryName("q9").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c9")).start()
    q.awaitTermination()
    assert {r.key for r in spark.table("q9").collect()} == {"a", "b", "c"}


def test_kmeans_recovers_clusters(spark):
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c, 0.1, (40, 2)) for c in ((0, 0), (5, 5), (0, 5))])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id bigint, v array<double>")
    centers, wss = kmeans.fit(df, "v", points[[0, 40, 80]])
    assert np.allclose(np.sort(centers.sum(1)), [0, 5, 10], atol=0.2) and wss < 10
    got = {r.id: r.cluster for r in kmeans.assign(df, "id", "v", centers).collect()}
    assert [len({got[i] for i in range(a, a + 40)}) for a in (0, 40, 80)] == [1, 1, 1]
    far = np.array([[0.0, 0.0], [99.0, 99.0]])
    assert (kmeans.fit(df, "v", far)[0][1] == [99, 99]).all()  # an empty cluster stays


def test_kmeans_queries_try_all_k_until_they_settle(spark, monkeypatch, tmp_path):
    from loomtable.plans import model_queries

    rng = np.random.default_rng(1)
    spark.createDataFrame([(i, rng.normal(0, 1, 3).tolist(), i % 4) for i in range(60)], "vec_id bigint, embedding array<double>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    allowed, fit = [], kmeans.fit

    def seen(df, vector, centers, iterations=100):
        allowed.append((len(centers), iterations))
        return fit(df, vector, centers, iterations)

    monkeypatch.setattr(kmeans, "fit", seen)
    rows = model_queries.kmeans_selection(spark, str(tmp_path)).collect()
    assert [r.k for r in rows] == [3, 4, 5, 6, 7, 8] and allowed == [(k, 100) for k in range(3, 9)]
    for f in (model_queries.kmeans_assign, model_queries.kmeans_profile):
        allowed.clear()
        f(spark, str(tmp_path)).collect()
        assert allowed == [(8, 100)]


def test_growth_slopes_are_recovered(spark):
    fits = growth.fit_all(growth.panel(spark))
    value = lambda m, t: next(x["estimate"] for x in fits[m]["terms"] if x["term"] == t)
    assert abs(value("linear", "time") - growth.LINEAR) < 0.1
    assert abs(value("quadratic", "time") - 6.0) < 0.25 and abs(value("quadratic", "time_sq") + 0.25) < 0.06
    assert abs(value("piecewise", "time_pre") - 5.0) < 0.15 and abs(value("piecewise", "time_post") - 1.5) < 0.2
    assert 0.5 < fits["linear"]["icc"] < 0.85 and fits["linear"]["groups"] == 90


def test_mixed_model_without_group_effect(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i % 30, float(x), float(2 + 3 * x + e)) for i, (x, e) in enumerate(zip(rng.normal(size=900), rng.normal(size=900)))], "g int, x double, y double")
    f = mixed.fit(df, "g", "y", ["x"])
    assert f["icc"] < 0.05 and abs(f["terms"][1]["estimate"] - 3) < 0.15 and (f["smallest"], f["largest"]) == (30, 30)


def test_item_parameters_are_recovered():
    rng = np.random.default_rng(2)
    theta, a, b = rng.normal(size=4000), np.array([0.8, 1.2, 1.6, 1.0, 1.4, 0.9, 1.1, 1.3]), np.linspace(-1.5, 1.5, 8)
    u = (rng.random((4000, 8)) < irt.probability(theta, a, b)).astype(float)
    patterns, n = np.unique(u, axis=0, return_counts=True)
    f = irt.fit(patterns, n.astype(float))
    assert np.corrcoef(f["b"], b)[0, 1] > 0.98 and f["log_likelihood"] >= irt.fit(patterns, n.astype(float), False)["log_likelihood"] - 1
    assert (irt.information(np.linspace(-3, 3, 61), a, b) > 0).all()
    assert abs(irt.chi2_tail(3.841459, 1) - 0.05) < 1e-6 and abs(irt.chi2_tail(20.12, 6) - 0.00263) < 1e-4


def test_differential_items(spark):
    rows = [("i", int(s), s % 2 == 0, k % 3) for k in range(90) for s in (k % 2, (k + 1) % 2 if k % 5 else k % 2)]
    out = irt.mantel_haenszel(spark.createDataFrame(rows, "item string, u int, focal boolean, s int"), "item", "u", "focal", "s").collect()
    assert len(out) == 1 and out[0]["class"] in ("A", "B", "C", "NA")


def test_factor_model_fits_its_own_data():
    rng = np.random.default_rng(3)
    f1 = rng.normal(size=3000)
    f2 = 0.6 * f1 + rng.normal(size=3000) * 0.8
    x = np.stack([f1 + rng.normal(size=3000) * 0.5, 0.9 * f1 + rng.normal(size=3000) * 0.5, f2 + rng.normal(size=3000) * 0.5, 1.1 * f2 + rng.normal(size=3000) * 0.5], 1)
    f = sem.fit(np.cov(x.T), 3000, [[0, 1], [2, 3]], [(1, 0)])
    assert f["cfi"] > 0.99 and f["srmr"] < 0.02 and abs(f["parameters"][2] - 0.6) < 0.08 and math.isfinite(f["rmsea"])
