"""Personal data, linkage, tokens, mixing and quality on small hand-made cases."""

import random

import numpy as np
import pytest

from loomtable.llm import linkage, mixing, pii, quality, tokens


def spans(text):
    return sorted((k, text[a:b]) for k, a, b in pii.typed_spans(text)[0])


@pytest.mark.parametrize(
    "text, want",
    [
        ("メールは aoi_1@mail.example です。", [("email", "aoi_1@mail.example")]),
        ("a.b+c [at] club [dot] example まで", [("email", "a.b+c [at] club [dot] example")]),
        ("ａｏｉ＠ｍａｉｌ．ｔｅｓｔ", [("email", "ａｏｉ＠ｍａｉｌ．ｔｅｓｔ")]),
        ("集合は10:00@体育館でした。", []),
        ("TEL:03-1234-5678", [("phone", "03-1234-5678")]),
        ("家の電話は+81-90-1234-5678です", [("phone", "+81-90-1234-5678")]),
        ("☎(03)1234-5678", [("phone", "(03)1234-5678")]),
        ("携帯 〇九〇の〇〇〇〇の一二三四 に", [("phone", "〇九〇の〇〇〇〇の一二三四")]),
        ("個人番号は1234-5678-9012です", [("id_number", "1234-5678-9012")]),
        ("学籍番号 S123456と書いた", [("id_number", "S123456")]),
        ("パスポート番号 ZZ 1234567", [("id_number", "ZZ 1234567")]),
        ("住所：〒123-4567 緋山県花筏市帆柱町1丁目2番3号", [("address", "〒123-4567 緋山県花筏市帆柱町1丁目2番3号")]),
        ("自宅は若葉台9番地の2です。", [("address", "若葉台9番地の2")]),
        ("図書の番号は978-0-000-00000-0です。", []),
        ("3-12教室で第12345回の演奏会に出た。", []),
        ("記録は1500mで4分12秒08でした。", []),
        ("星見市の大会で3位", []),
    ],
)
def test_spans_with_a_grammar(text, want):
    assert spans(text) == want


def test_names_by_what_they_give_away(spark):
    common = [(k, f"{k}日に聖ルミナさんと試合をしました。担任の○○先生や校長先生、皆さんに感謝します。", "高校生") for k in range(60)]
    rare = [
        (100, "相談相手は樫倉燈葉さんでした。", "霜畑さん・中学生"),
        (101, "My teacher Ms. Hishikura encouraged me.", "高校生：カリヅカウタマ"),
        (102, "私、櫂路琥希は立候補しました。メールは a@b.example です。", None),
        (103, None, ""),
    ]
    df = spark.createDataFrame([(a, b, c, "x") for a, b, c in common + rare], "record_id bigint, quote_text string, speaker_attribute string, key string")
    rows = pii.fields_of(df, "record_id", ["quote_text", "speaker_attribute"])
    found = {(r.key, r.field_name, r.pii_type) for r in pii.find_personal_data(rows).collect()}
    assert found == {
        (100, "quote_text", "name"),
        (100, "speaker_attribute", "name"),
        (101, "quote_text", "name"),
        (101, "speaker_attribute", "name"),
        (102, "quote_text", "name"),
        (102, "quote_text", "email"),
    }
    texts = {(r.key, r.field_name): r.redacted_text for r in pii.redacted(rows).collect()}
    assert texts[100, "quote_text"] == "相談相手は[NAME]さんでした。"
    assert texts[102, "quote_text"] == "私、[NAME]は立候補しました。メールは [EMAIL] です。"
    assert texts[0, "quote_text"] == common[0][1]
    assert pii.find_personal_data(rows.limit(0)).count() == 0


def test_redaction_takes_the_longest_of_overlapping_spans():
    assert pii.redact("abcdef", [("name", 1, 3, ""), ("email", 1, 5, ""), ("phone", 4, 6, "")]) == "a[EMAIL]f"
    assert pii.redact("abcdef", [("address", 1, 5, "bc")]) == "abc[ADDRESS]f"


def found_in(spark, records, **options):
    """{(key, field, type, what stands there)} of records (id, school, quote, attribute)."""
    df = spark.createDataFrame(records, "id bigint, school string, quote string, attribute string")
    rows = pii.fields_of(df, "id", ["quote", "attribute"], "school")
    text = {(r.key, r.field_name): r.text for r in rows.collect()}
    got = pii.find_personal_data(rows, **options).collect()
    assert all(r.bits > 0 and 0 <= r.concentration <= 1 for r in got)
    return {(r.key, r.field_name, r.pii_type, text[r.key, r.field_name][r.start : r.stop]) for r in got}


def test_common_names_of_one_school_and_shared_words(spark):
    """Beyond the bits a term gives away of the voice, its concentration in a group counts."""
    records = [(k, "big" if k % 3 == 0 else f"s{k % 40}", f"{k}回目の日記です。" + ("担任の樫倉先生に相談しました。" if k % 3 == 0 else "聖ルミナさんと試合をしました。" if k % 7 == 0 else ""), "高校生") for k in range(4000)]
    got = found_in(spark, records)
    assert {w for _, _, _, w in got} == {"樫倉"}
    assert {k for k, _, _, _ in got} == set(range(0, 4000, 3))


def test_a_record_alone_and_in_a_large_corpus(spark):
    record = (1, "s1", "相談相手は樫倉燈葉さんでした。電話は090-1234-5678、住所は緋山県花筏市帆柱町1丁目2番3号です。", "帰国生（霜畑さん）")
    want = {(1, "quote", "name", "樫倉燈葉"), (1, "quote", "phone", "090-1234-5678"), (1, "quote", "address", "緋山県花筏市帆柱町1丁目2番3号"), (1, "attribute", "name", "霜畑")}
    many = [(k, f"s{k % 50}", f"{k}日目に合唱部の先生と話しました。", "帰国生") for k in range(2, 5000)]
    assert want <= found_in(spark, [record])
    assert found_in(spark, [record, *many]) == want


def test_names_outside_of_frames(spark):
    records = [(1, "a", "相談相手は樫倉燈葉さんでした。", None), (2, "b", "壇上には樫倉燈葉が立ち、拍手が起きた。", None), (3, "c", "樫倉燈葉園の前で待った。", None)]
    records += [(4, "d", "希望丘さんがいた。", None), (10, "f", "隣は樫倉燈葉さん。", None)] + [(k, "e", f"{k}人で希望丘まで歩いた。", None) for k in range(5, 9)]
    got = found_in(spark, records)
    assert {(k, w) for k, _, _, w in got} == {(1, "樫倉燈葉"), (2, "樫倉燈葉"), (10, "樫倉燈葉"), (4, "希望丘")}  # 希望丘 stands mostly outside of frames


def test_a_garbled_text_that_holds_a_name(spark):
    text = "縺薙ｓ縺ｫ縺｡縺ｯ縲ょ⊂縺励＞譛ｬ縺後≠繧翫∪縺吶縺薙ｓ縺ｫ縺｡縺ｯ。相談相手は樫倉燈葉さんでした。"
    assert (1, "quote", "name", "樫倉燈葉") in found_in(spark, [(1, "a", text, None)])


def test_addresses_are_cut_down_to_what_many_share(spark):
    records = [(k, f"s{k % 9}", f"{k}番目、緋山県水鏡町から通う。", None) for k in range(400)] + [(900, "x", "住所：緋山県水鏡町5-6-7。", None), (901, "y", "住所：〒123-4567 翠川県帆柱町8-9-10。", None)]
    df = spark.createDataFrame(records, "id bigint, school string, quote string, attribute string")
    rows = pii.fields_of(df, "id", ["quote"], "school")
    for generalise, want in ((False, ["住所：[ADDRESS]。", "住所：[ADDRESS]。"]), (True, ["住所：緋山県水鏡町[ADDRESS]。", "住所：[ADDRESS]。"])):
        made = pii.redacted(rows, threshold={"name": 6.0}, generalise=generalise).filter("key >= 900").orderBy("key").collect()
        assert [r.redacted_text for r in made] == want


def test_extra_columns_and_far_places():
    assert spans("あ" * 200 + "緋山県花筏市" + "帆柱" * 10 + "町1丁目2番3号")[0][0] == "address"


MASTER = [
    ("s1", "蒼森学園中学校", "そうもりがくえんちゅうがっこう", "青柳町", "碧海県", 1925, "学校法人蒼森学院", "coed"),
    ("s1", "蒼森​学園中学校", None, "青柳町", "碧海県", 1925, None, "coed"),
    ("s2", "蒼森学園中学校", None, "水門市", "銀嶺県", 1960, None, "girls"),
    ("s3", "琥ノ宮中等教育学校", "このみやちゅうとうきょういくがっこう", "星見市", "翠川県", 1980, None, "coed"),
]
CLAIMS = [
    (1, "蒼森学園中学校", "伝記によれば、碧海青柳町の学校、大正14年創立である蒼森に学んだ。", "s1"),
    (2, "Soumori Gakuen", "銀嶺県水門市にあった学び舎、昭和35年創立、女子校である同校に学んだ。", "s2"),
    (3, "琥の宮中等教育学校", "翠川県星見市の学校である同校を卒業した。", "s3"),
    (4, "蒼森大学", "碧海県の蒼森大学を卒業した。", None),
    (5, "蒼森学園中学校", "緋山木綿町にあった学び舎、1883年に開かれた学校である同校に学んだ。", None),
    (6, None, None, None),
    (7, "", "", None),
    (8, None, "琥ノ宮中等教育学校を卒業した。翠川県星見市、1980年創立の学校である。", "s3"),
]


def test_claims_meet_their_schools(spark):
    master = spark.createDataFrame(MASTER, "id string, name string, kana string, town string, prefecture string, year int, operator string, pupils string")
    rows = [(k * 100 + n, a, b, "x") for k, a, b, _ in CLAIMS for n in range(6)]
    claims = spark.createDataFrame(rows, "record_id bigint, name string, snippet string, key string")
    got = {r.key: r.school_id for r in linkage.matches(claims, "record_id", "name", "snippet", master).collect()}
    assert got == {k * 100 + n: s for k, _, _, s in CLAIMS if s for n in range(6)}
    assert linkage.matches(claims.limit(0), "record_id", "name", "snippet", master).count() == 0
    assert linkage.matches(claims, "record_id", "name", "snippet", master.limit(0)).count() == 0


def test_names_and_snippets_are_parsed():
    assert linkage.parse_name("私立翠原女学院中学校")["kind"] == "女||院"
    assert linkage.parse_name("Satsuhama Junior High School")["keys"] == ["s:satsuhama"]
    assert linkage.parse_name("ひのきのがくえんちゅうとうぶ")["level"] == "part"
    assert linkage.parse_name("凪ノ宮大学") is None
    assert linkage.romanised("しゅんじゅっか") == "shunjukka"
    said = linkage.parse_snippet("経営は学校法人燈坂学園、明治元年創立、共学、灯台北町で少年期を過ごし、地元の学校である燈坂に学んだ。")
    assert (said["year"], said["operator"], said["pupils"], said["place"]) == (1868, "燈坂学園", "coed", "灯台北町")


def test_readings_of_schools_on_a_height_are_no_universities():
    for written, read in (("院", "いん"), ("園", "えん"), ("舎", "しゃ")):
        for end in ("ちゅうがっこう", "ちゅうとうぶ", ""):
            got = linkage.parse_name(f"こだいがく{read}{end}")
            assert got["kind"] == f"||{written}" and got["keys"] == ["t:こだい", "s:kodai"]
    assert linkage.parse_name("こだいがくえちゅうがっこう")["level"] == "junior"  # a sign lost
    for other in ("なぎのみやだいがく", "なぎのみやだいがくほうがくぶ", "凪ノ宮大学", "凪ノ宮大学院", "こだいしょうがっこう"):
        assert linkage.parse_name(other) is None


def test_claims_meet_a_school_read_with_daigaku(spark):
    master = spark.createDataFrame([("s4", "琥台学舎中学校", "こだいがくしゃちゅうがっこう", "水門港市", "碧海県", 1964, None, "girls"), *MASTER], "id string, name string, kana string, town string, prefecture string, year int, operator string, pupils string")
    said = [("こだいがくしゃちゅうがっこう", "碧海県水門港市の学校、女子校、昭和39年創立である同校に在籍した。", "s4"), ("Kodai Gakusha", "碧海県水門港市の学校、昭和39年創立である同校で教鞭をとった。", "s4"), ("こだいだいがく", "碧海県水門港市の学校、昭和39年創立である同校に学んだ。", None)]
    rows = [(k * 100 + n, a, b) for k, (a, b, _) in enumerate([*said, *(c[1:] for c in CLAIMS)]) for n in range(6)]
    claims = spark.createDataFrame(rows, "record_id bigint, name string, snippet string")
    got = {r.key: r.school_id for r in linkage.matches(claims, "record_id", "name", "snippet", master).collect() if r.key < 300}
    assert got == {k * 100 + n: s for k, (_, _, s) in enumerate(said) if s for n in range(6)}


def test_posteriors_of_a_claim_exclude_each_other():
    m = linkage.Mixture()
    x = np.array([[1.0] * 8, [1.0] * 8, [0.0] * 8, [np.nan] * 8])
    p = m.posteriors(x, np.array([0, 0, 1, 2]))
    assert p[0] == p[1] <= 0.5 and p[2] < 0.01 and abs(p[3] - m.weight) < 1e-6


def test_tree_reduction_is_exact():
    v = tokens.vocabulary()
    rng = random.Random(1)
    alphabet = "ab1 '\n\t。、あ漢é  9²!?-_’s​　👩‍🏫d llvere"
    texts = ["", "a", "  ", "漢" * 5000, "x" * 3000, "' " * 700, "don't we'll I've " * 300, "<|endoftext|>", "😀" * 999]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    want = v.plain(texts)
    for leaf in (1, 5, 64, 1024):
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(tokens.encode_all(texts, leaf=leaf), want))
    assert tokens.decode_all(want) == texts


def test_ids_of_nulls_and_of_empty_tables(spark):
    df = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "ab。", 9), (3, "ab。", 9)], "doc_id bigint, text string, ids int")
    rows = sorted((r.doc_id, list(r.ids)) for r in tokens.encoded(df, "doc_id", "text").collect())
    assert rows[:2] == [(1, []), (2, [])] and rows[2] == rows[3]
    back = {r.doc_id: r.text for r in tokens.decoded(tokens.encoded(df, "doc_id", "text"), "doc_id", "ids").collect()}
    assert back == {1: "", 2: "", 3: "ab。"}
    assert tokens.encoded(df.limit(0), "doc_id", "text").count() == 0
    assert {r.doc_id: r.n_tokens for r in tokens.token_counts(df, ["doc_id"], "text").collect()}[2] == 0


def test_budgets_reach_siblings_before_ancestors():
    leaves = {"a": (("x", "ja"), 0.25, 10.0), "b": (("x", "ja"), 0.25, 1000.0), "c": (("y", "ja"), 0.25, 1000.0), "d": (("z", "en"), 0.25, 0.0)}
    got = mixing.budgets(400, leaves)
    # x has half of all; d's quarter goes to x and y by their targets; what a lacks is b's
    assert got["a"] == 10 and got["d"] == 0
    assert abs(got["b"] - (800 / 3 - 10)) < 1e-6 and abs(got["c"] - 400 / 3) < 1e-6
    assert mixing.budgets(1e9, leaves) == {"a": 10.0, "b": 1000.0, "c": 1000.0, "d": 0.0}


def test_mix_keeps_shares_and_caps(spark):
    rng = random.Random(2)
    rows = [(k, s, "ja", rng.randint(1, 50)) for s, n in (("a_1", 3000), ("a_2", 300), ("b_1", 20), ("none", 50)) for k in range(hash_base(s), hash_base(s) + n)]
    rows += [(900001, "a_1", None, 0), (900002, None, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_tokens bigint")
    targets = spark.createDataFrame([("a_1", 0.5, 1), ("a_2", 0.3, 4), ("b_1", 0.1, 2), ("gone", 0.1, 9)], "source string, target_share double, max_repeats int")
    mix, shares = mixing.mixed(docs, targets, total_tokens=20000.0)
    size = {r[0]: r[3] for r in rows}
    taken = mix.collect()
    assert len({r.doc_id for r in taken}) == len(taken) and all(1 <= r.copies <= {"a_1": 1, "a_2": 4, "b_1": 2}[r.source] for r in taken)
    got = {r.source: r for r in shares.collect()}
    for s in ("a_1", "a_2", "b_1"):
        assert got[s].mix_tokens == sum(size[r.doc_id] * r.copies for r in taken if r.source == s)
        assert abs(got[s].mix_tokens - got[s].budget) <= 26
    assert got["gone"].mix_tokens == 0
    assert {(r.doc_id, r.copies) for r in mixing.mixed(docs, targets, total_tokens=20000.0)[0].collect()} == {(r.doc_id, r.copies) for r in taken}
    assert mixing.mixed(docs.limit(0), targets)[0].count() == 0


def hash_base(source):
    return {"a_1": 0, "a_2": 10000, "b_1": 20000, "none": 30000}[source]


def common(spark):
    return spark.createDataFrame([("en", "the", 1), ("en", "is", 2), ("ja", "は", 1), ("ja", "ました", 2), (None, None, None)], "lang string, word string, word_rank int")


def test_statistics(spark):
    english, japanese = quality.common_word_lists(common(spark))
    df = spark.createDataFrame([(1, "The cat is here.\n\n猫は寝ました。\nno end", 0), (2, None, 0), (3, "", 0), (4, " 　\n", 0)], "doc_id bigint, text string, n_words int")
    rows = {r.doc_id: r for r in quality.text_statistics(df, "doc_id", "text", english, japanese).collect()}
    one = rows[1]
    assert (one.n_words, one.n_lines, one.ended_line_share) == (10, 3, round(2 / 3, 6))
    assert one.common_word_share == 0.4
    assert all(rows[k].n_words == 0 and rows[k].symbol_ratio == 0 for k in (2, 3, 4))


PROSE = "朝の光が教室に差しこむと、みんなの声が少しずつ大きくなりました。私は窓の外を見ながら、今日のことを考えていました。"
ENGLISH = "The hall was full when we came in. Nobody spoke, but everyone was waiting for the music to begin."


def test_prose_and_junk_are_told_apart(spark):
    prose = [PROSE * n for n in range(1, 7)] + [ENGLISH * n for n in range(1, 7)] + ["\n".join(PROSE[i : i + 12] for i in range(0, len(PROSE), 12)), "Q: " + PROSE + "\nA: " + ENGLISH, "# 題\n" + PROSE * 3 + "\n・一\n・二"]
    junk = ["\n".join(["国語", "数学", "体育"] * n) for n in range(2, 8)] + ["a,b,c\n1,2,3\n4,5,6\n" * n for n in range(1, 7)] + ["<div><a href='/x'></a></div>" * 5, "click here " * 20, "12 345 6789 " * 9]
    rows = [(k, t, 0) for k, t in enumerate(prose * 3)] + [(1000 + k, t, 0) for k, t in enumerate(junk * 3)] + [(5000, None, 0), (5001, "", 0), (5002, " \n", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, key int")
    got = {r.key: r.junk_probability for r in quality.scored(df, "doc_id", "text", common(spark)).collect()}
    assert len(got) == len(rows) - 3
    assert all((p > 0.5) == (k >= 1000) for k, p in got.items()), [k for k, p in got.items() if (p > 0.5) != (k >= 1000)]
    assert quality.scored(df.limit(0), "doc_id", "text", common(spark)).count() == 0


def test_holdout_is_judged_as_by_hand(spark):
    english, japanese = quality.common_word_lists(common(spark))
    h = quality.holdout_features(spark, english, japanese)
    label = quality.weak_label(h[:, 1:])
    assert ((label < 0) | (label == h[:, 0])).mean() > 0.95


ODD = ["a'b'c d'e f''g", "a\rb。\rc。 \r\n x", "。 。\n「あ」 ", " a. b", "", "  ", "it's I'm don't the", "１２３ 4 五。", "a.\x85b", "・一\n・二\n・三", "学校の 生徒　です。\n\n先生は、と言った」", "the and The AND", "ー々ヶぁゖ", "😀,；|\t>"]


def test_statistics_of_both_ways_are_the_same(spark):
    english, japanese = ["the", "and", "it"], ["学校", "学", "の", "です"]
    df = spark.createDataFrame(list(enumerate(ODD)), "id bigint, text string")
    rows = sorted(quality.text_statistics(df, "id", "text", english, japanese).collect(), key=lambda r: r.id)
    made = quality.statistics(ODD, frozenset(english), japanese)
    assert np.allclose(made, np.array([[float(r[c]) for c in quality.FEATURES[:8]] for r in rows]), atol=1.5e-6)
    assert np.array_equal(made, np.concatenate([quality.statistics([t], frozenset(english), japanese) for t in ODD]))


def test_shapes_do_not_depend_on_the_batch_and_read_long_texts_whole():
    texts = [t for t in ODD if t.strip()] + ["あい。", "We walk and we talk to them. x"]
    together = quality.shapes(texts)
    assert np.allclose(together, np.concatenate([quality.shapes([t]) for t in texts]))
    shape = dict(zip(quality.SHAPES, quality.shapes(["abc def、ghijk. あ\nいう"])[0]))
    assert shape["longest_word"] == 5 and shape["hiragana_share"] == 3 / 16 and shape["delimiter_ratio"] == 0
    # the grams of the second half differ from each other: a sample of every so many would not tell
    long = "ab" * 75_000 + "".join(chr(0x4E00 + k % 20_000) for k in range(150_000))
    grams = {long[k : k + 4] for k in range(len(long) - 3)}
    assert dict(zip(quality.SHAPES, quality.shapes([long])[0]))["distinct_share"] == pytest.approx(len(grams) / (len(long) - 3), abs=1e-4)
