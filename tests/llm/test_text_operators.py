"""Residue, cut texts, wrong decoding and consistent forms on small hand-made cases."""

import random
import re
import time
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomtable.llm import confusables, mojibake, residue, truncation

PROSE = "この学校に入って、勇気の大切さを知りました。"


def kinds(spark, texts):
    df = spark.createDataFrame([(k, t, ["old"]) for k, t in enumerate(texts)], "id bigint, text string, residue_kinds array<string>")
    return [r.residue_kinds for r in sorted(residue.find_residue(df, "text").collect(), key=lambda r: r.id)]


RESIDUE = [
    ("{{name}}より", "placeholder"),
    ("${motto}", "placeholder"),
    ("<%= year %>年の春", "placeholder"),
    ("<?php echo $title; ?>", "placeholder"),
    ("[name id=3]に学ぶ", "placeholder"),
    ("【学校名を入力】からのメッセージ", "placeholder"),
    ("（氏名未設定）", "placeholder"),
    ("%NAME% and __YEAR__", "placeholder"),
    ("&lt;year&gt;の思い出", "placeholder"),
    ("ここに文章。テキストが入ります。", "filler"),
    ("Lorem ipsum dolor", "filler"),
    ("Nosteci rem adqui sumpis lo turnia.", "filler"),
    ("あああああああああああああああああああ", "filler"),
    ("本文本文本文本文本文本文", "filler"),
    ("TBD", "filler"),
    ("（準備中）コンテンツは近日公開予定です。", "filler"),
    ("404 Not Found", "error"),
    ("５０３　エラーです", "error"),
    ("Fatal error: Uncaught Error in /srv/a.php:3", "error"),
    ("お探しのページは見つかりませんでした。", "error"),
    ("JavaScriptを有効にしてください。", "script"),
    ("Please enable cookies.", "script"),
    ("お使いのブラウザはサポートされていません。", "script"),
]


def test_residue_is_found_alone_and_inside_prose(spark):
    for (text, kind), alone, inside in zip(RESIDUE, kinds(spark, [t for t, _ in RESIDUE]), kinds(spark, [f"{PROSE}\n{t}" for t, _ in RESIDUE])):
        assert kind in alone, (text, alone)
        if text != "TBD":  # a bare mark is one only alone
            assert kind in inside, (text, inside)


def test_what_is_spoken_of_is_no_residue(spark):
    clean = [
        PROSE,
        "集合の記号 {a, b, c} を初めて見たときは戸惑いました。",
        "作品は、わざと「404」と表示される迷路でした。",
        '英語の授業では"not found"という題の詩を書きました。',
        "プログラミングの時間にJavaScriptを学びました。",
        "「ここに名前を書く」という場面で笑いました。",
        "100%の力で走り、次は120%を目指します。",
        "担任の○○先生に相談しました。",
        "テンプレートの構文では {{name}} のように変数を書くと先生が教えてくれて、長い説明を最後まで聞きました。" + PROSE * 3,
        "`{{name}}` is how you write it.",
        "ああ、あのときの自分に伝えたいです。",
        "古い辞書の [12] や <注> を手がかりに読みました。",
        None,
        "",
        "  　",
    ]
    assert kinds(spark, clean) == [[]] * len(clean)


def test_grammars_have_no_bound_and_tutorials_end_with_their_sentence(spark):
    long, kana = "".join(f"a{k}" for k in range(2000)), "".join(chr(0x3042 + k % 60) for k in range(300))
    found = kinds(spark, [f"{{{{{long}}}}}", f"<?php echo $page->title;\n{long} ?>", f"【{kana}を入力してください】", f"「{kana}{{{{x}}}}」という文字を見た。", f"`{'a ' * 300}{{{{x}}}}` is code.", "国際プログラムの書き方を学びました。{{school_name}}の生徒です。", "テンプレートの構文では {{name}} のように変数を書く。\n担任は {{teacher}} です。", "{{title}}{{body}}{{name}}テンプレート"])
    assert found == [["placeholder"], ["placeholder"], ["placeholder"], [], [], ["placeholder"], ["placeholder"], ["placeholder"]]


def test_required_literals_stand_in_every_match():
    assert residue.required(r"(?i)(?:Turn on|allow)\s+cookies?") == {"cookie"}
    assert residue.required(r"a?b*") is None and residue.required(r"(?:ab|c*)x") == {"x"} and residue.required("[xy]+z?") == {"x", "y"}
    for text, _ in RESIDUE:
        for p in (a for patterns in residue.KINDS.values() for q in patterns.values() for a in ([q] if "\\1" in q else residue.alternatives(q))):
            if re.search(p.replace(r"\z", r"\Z"), text) and residue.required(p):
                assert any(x in text.lower() for x in residue.required(p)), (p, text)


def test_residue_of_empty_tables_and_long_texts(spark):
    assert kinds(spark, []) == []
    assert kinds(spark, [PROSE * 20000 + "{{name}}", PROSE * 20000]) == [["placeholder"], []]
    df = spark.createDataFrame([(1, "{{a}}"), (1, "{{a}}"), (2, None)], "id int, t string")
    assert [r.id for r in residue.without_residue(df, "t").collect()] == [2]


CORPUS = [f"{a}では、失敗を恐れずに挑む姿が数多く見られます。私たちは{b}を大切にしています。学ぶことは楽しいことでもあります。" for a in ("合唱祭", "遠足", "文化祭", "体育祭") for b in ("勇気", "対話", "自由", "和")] + [
    "We believe that honesty grows when our students are trusted. They carry this spirit into the wider world."
] * 4


@pytest.mark.parametrize(
    "tail, cut",
    [
        ("遠足では、失敗を恐れずに挑む姿が数多く見られ", True),
        ("私たちは勇気を大切にしてい", True),
        ("私たちは勇気を大切にしています", False),
        ("合唱祭では、", True),
        ("私たちは…", True),
        ("私たちは勇気を大切にしています。（校長　○○）", False),
        ("私たちは勇気を大切にしています。\n学園長", False),
        ("学ぶことは「楽しい", True),
        ("学ぶことは楽しいことでもあります！", False),
        ("私たちは勇気を大切�", True),
        ("They carry this spirit into the wid", True),
        ("They carry this spirit into the wider", True),
        ("They carry this spirit into the wider world", False),
        ("", False),
        ("  ", False),
        (None, False),
    ],
)
def test_cut_texts(spark, tail, cut):
    rows = [(k, t, "x") for k, t in enumerate(CORPUS)] + [(999, tail, "x"), (1000, tail, "y")]
    df = spark.createDataFrame(rows, "record_id bigint, quote string, is_cut string")
    found = {r.key: r.is_cut for r in truncation.find_cut(df, "record_id", "quote").filter("key >= 999").collect()}
    assert found == {999: cut, 1000: cut}


def test_walk_of_the_trie_against_brute_force(spark):
    rng = random.Random(2)
    some = lambda: "".join(rng.choice("abあ") for _ in range(rng.randint(1, 5)))
    vocabulary = [(w, rng.randint(1, 9)) for w in {some() for _ in range(80)}]
    asked = {some() for _ in range(60)} | {"zz", "a"}
    got = truncation.prefixes(spark.createDataFrame([(w,) for w in asked], "word string"), spark.createDataFrame(vocabulary, "word string, n bigint"))
    assert {r.word: r.longer for r in got.collect()} == {a: sum(n for w, n in vocabulary if w != a and w.startswith(a)) for a in asked}


def test_very_long_words_and_lengths(spark):
    word = "ab" * 20_000
    rows = [(1, f"We met {word} there. Then {word} left."), (2, f"We met {word[:30_000]}"), (3, f"We met {word}"), (4, None)]
    rows += [(k, "x y z" + " w" * (k % 7) + "。") for k in range(10, 40)]
    found = {r.key: (r.is_cut, r.evidence) for r in truncation.find_cut(spark.createDataFrame(rows, "id bigint, t string"), "id", "t").collect()}
    assert found[2] == (True, "prefix") and found[4] == (False, "none") and not found[1][0]
    # an unknown last word that is no prefix: only where far more texts end at that length than around it
    short, limit = [(k, f"話をします。{chr(0x4E00 + k)}{'の' * (k % 13)}") for k in range(100)], [(k, f"話をします。{chr(0x5E00 + k)}朝へ行く") for k in range(200, 300)]
    found = {r.key: (r.is_cut, r.evidence) for r in truncation.find_cut(spark.createDataFrame(short + limit, "id bigint, t string"), "id", "t").collect()}
    assert all(found[k] == (True, "length") for k, _ in limit) and not any(found[k][0] for k, t in short if len(t) != 11)


def test_cut_of_an_empty_table(spark):
    assert truncation.find_cut(spark.createDataFrame([], "id bigint, t string"), "id", "t").count() == 0


ORIGINAL = "合唱祭では、失敗を恐れずに挑む姿が数多く見られます。"
GARBLED = [
    ORIGINAL.encode().decode("latin-1"),
    "".join(bytes([b]).decode("cp1252", "replace") if bytes([b]).decode("cp1252", "replace") != "�" else chr(b) for b in ORIGINAL.encode()),
    ORIGINAL.encode().decode("mac_roman"),
    ORIGINAL.encode("euc_jp").decode("latin-1"),
    ORIGINAL.encode().decode("latin-1").encode().decode("latin-1"),
    ORIGINAL.encode("iso2022_jp").replace(b"\x1b", b"").decode("ascii"),
    "".join(f"&#{ord(c)};" for c in ORIGINAL),
    "".join(f"\\u{ord(c):04x}" for c in ORIGINAL),
    "".join(f"%{b:02X}" for b in ORIGINAL.encode()),
]


def test_wrong_decoding_is_undone():
    for text in GARBLED:
        found, restored, steps = mojibake.judge(text)
        assert found and restored == ORIGINAL and steps, (text, restored)
    found, restored, _ = mojibake.judge(PROSE + GARBLED[0] + PROSE)
    assert found and restored == PROSE + ORIGINAL + PROSE
    found, restored, _ = mojibake.judge("It isn’t late.".encode().decode("cp1252"))
    assert found and restored == "It isn’t late."


def test_lossy_decoding_is_found_but_not_restored():
    for text in (ORIGINAL.encode("cp932").decode("utf-8", "replace"), ORIGINAL.encode().decode("cp932", "ignore"), ORIGINAL.encode().decode("gbk", "replace")):
        found, restored, _ = mojibake.judge(text)
        assert found and (restored is None or restored != text), text


def test_rare_characters_are_no_garbage(spark):
    clean = [PROSE, "「Café à l’été」という詩を読みました。", "ドイツの留学生はÄpfelとÜbungの発音を教えてくれました。", "彅や齋、髙、𠮷といった字を練習しました。", "ﾊﾝｶｸのまま書きました。", "「縺れる」「譁」を辞書で引いた。", "気温は−5℃、心は±0ではなく☆", "ÅrstidとÉcoleを並べて書いた。", "¿Qué?という表現", "🎓👩‍🏫", None, "", "  "]
    assert [f for f, _, _ in mojibake.judge_all(clean)] == [False] * len(clean)
    df = spark.createDataFrame([(k, t, "x") for k, t in enumerate(clean + GARBLED[:1])], "id int, text string, restored string")
    rows = sorted(mojibake.with_restored(df, "text").collect(), key=lambda r: r.id)
    assert [r.is_garbled for r in rows] == [False] * len(clean) + [True]
    assert rows[-1].restored == ORIGINAL
    assert mojibake.with_restored(df.limit(0), "text").count() == 0


def test_search_ends_on_long_texts():
    found, restored, _ = mojibake.judge(GARBLED[0] * 2000)
    assert found and restored == ORIGINAL * 2000


def test_several_kinds_of_damage_in_one_text():
    pieces = [GARBLED[0], PROSE, GARBLED[2], "\n", GARBLED[3], PROSE, GARBLED[4], "\n", GARBLED[6]]
    found, restored, steps = mojibake.judge("".join(pieces))
    assert found and restored == "".join(ORIGINAL if p in GARBLED else p for p in pieces) and len(set(steps)) >= 4
    six = ORIGINAL
    for _ in range(6):
        six = six.encode().decode("latin-1")
    assert mojibake.judge(six)[1] == ORIGINAL


def test_search_over_long_lossy_texts_ends():
    lossy = (ORIGINAL * 100).encode().decode("cp1252", "replace").encode().decode("cp1252", "replace")
    began = time.time()
    found, restored, _ = mojibake.judge(lossy)
    assert found and restored is None and time.time() - began < 20


SAME = [
    ("ＡＢＣ　１２", "ABC 12"),
    ("ﾄﾞｱ", "ドア"),
    ("ト゛".replace("゛", "゙"), "ド"),
    ("été", "été"),
    ("学​校﻿", "学校"),
    ("観察⼒", "観察力"),
    ("コート", "コ一ト"),
    ("ロ口", "口ロ"),
    ("Ѕсhооl", "School"),
    ("a\xa0b c", "a b c"),
    ("⻑い", "長い"),
    ("神", "神"),
    ("a\r\nb", "a\nb"),
]
DIFFERENT = [("学", "學"), ("は", "ば"), ("つ", "っ"), ("A", "a"), ("１", "①"), ("です", "だ"), ("カ", "ガ"), ("x2", "x²"), ("a b", "a\nb"), ("か", "カ")]


def test_looks_decide():
    for a, b in SAME:
        assert len(set(confusables.skeletons([a, b]))) == 1, (a, b)
        assert len(set(confusables.skeletons([a, b], True))) == 1, (a, b)
    for a, b in DIFFERENT:
        assert len(set(confusables.skeletons([a, b]))) == 2, (a, b)
        assert len(set(confusables.skeletons([a, b], True))) == 2, (a, b)


def test_forms_do_not_depend_on_the_batch_and_are_stable():
    texts = [t for pair in SAME + DIFFERENT for t in pair] + ["", "゙", "カ", "゙x", "漢字とカタカナのコート"]
    for readable in (False, True):
        together = confusables.skeletons(texts, readable)
        assert together == [confusables.skeletons([t], readable)[0] for t in texts]
        assert confusables.skeletons(together, readable) == together
        assert all(unicodedata.normalize("NFC", t) == t for t in together)


def named(df, table_name, key, text):
    return df.select(F.lit(table_name).alias("table_name"), F.col(key).alias("key"), F.col(text).alias("text"))


def test_pairs_and_classes_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(confusables, "BLOCK", 2)
    texts = [t for pair in SAME for t in pair] * 2 + [None, "", "", " "] + [t for pair in DIFFERENT for t in pair] + ["ＡＢＣ 12"] * 7
    rows = list(enumerate(texts))
    df = named(spark.createDataFrame([(k, t, "x") for k, t in rows], "id bigint, text string, looks string"), "t", "id", "text")
    got = sorted((r.key_lo, r.key_hi) for r in confusables.alike_pairs(df).collect())
    skeleton = dict(zip((k for k, _ in rows), confusables.skeletons([t or "" for t in texts])))
    want = sorted((i, j) for i, a in rows for j, b in rows if i < j and a is not None and b is not None and a != b and skeleton[i] == skeleton[j])
    assert got == want
    monkeypatch.setattr(confusables, "BROADCAST_PAIRS", 0)
    assert sorted((r.key_lo, r.key_hi) for r in confusables.alike_pairs(df).collect()) == want
    classes = {r.key: (r.class_key, r.n_links) for r in confusables.alike_classes(df).collect()}
    alike = lambda i: [(j, b) for j, b in rows if b is not None and skeleton[j] == skeleton[i]]
    assert classes == {i: (min(j for j, _ in alike(i)), sum(b != a for _, b in alike(i))) for i, a in rows if a is not None}
    assert confusables.alike_pairs(df.limit(0)).count() == 0 and confusables.alike_classes(df.limit(0)).count() == 0


def test_copies_of_a_common_string_are_never_paired(spark):
    rows = spark.range(100_001).select(F.lit("t").alias("table_name"), F.col("id").alias("key"), F.when(F.col("id") == 100_000, "学 校").otherwise("学\u3000校").alias("text"))
    began = time.time()
    assert confusables.alike_pairs(rows).count() == 100_000
    assert time.time() - began < 60


def test_arrays_of_code_points_and_long_runs_of_marks():
    texts = ["a", None, "", "が\u0323\u0301😀é", "x" * 5000]
    column = pa.array(texts, pa.string())
    for given in (column, column.slice(1, 3), column.slice(5)):
        points, row = confusables.points_of(given)
        assert confusables.array_of(points, row, given).to_pylist() == given.to_pylist()
    marks = "".join(chr(0x300 + (i * 37) % 50) for i in range(20_000))
    (form,) = confusables.skeletons(["a" + marks])
    classes = [unicodedata.combining(c) for c in form[1:]]
    assert sorted(classes) == classes
    points, row = confusables.points_of(pa.array(["ab", "ba", "", "ab", "a"]))
    h = confusables.hashes(points, row, 5).to_pylist()
    assert h[0] == h[3] and len(set(h)) == 4
