"""Personal data in free text, by how strongly terms reveal who is meant.

Grammars and frames only propose terms: mail addresses, telephone and identity numbers,
street addresses by their forms, names where people are named (before a title or a form of
address, after a self-introduction, in a by-line, as what is left of a description of a
speaker). What a term gives away is then measured by its co-occurrence over the whole corpus
with the entities to be protected:

 - voices: the persons who speak, one per distinct record of an entity, however often it was
   delivered. Term t, met in n of V voices, tells log2(V / n) bits about which one is meant,
   estimated with a prior (PRIOR_VOICES voices in which a term has frequency PRIOR_SHARE), so
   that one formula holds for a single record and for any number;
 - groups (schools): a term common enough to tell little about the voice may still stand in
   one group only. Its pointwise mutual information with the group it is met in most, over
   the most it could be, is its concentration: 1 where the term gives the group away, 0
   where it is spread as all voices are.

A term is disclosing if its bits reach THRESHOLD_BITS of its type, or if its concentration
reaches CONCENTRATION while it is met in at least two voices and a group of a size that
leaves something to tell. Titles, school teams and roles are shared by many and spread;
names are not. Every span carries its bits and its concentration.

A disclosing name that stands mostly in frames is a name elsewhere too: it is looked up in
all texts and found outside of any frame, as long as most of its places in the corpus are
frames (NAMED_SHARE).

Terms are removed (a placeholder of their type), or generalised: of an address the longest
beginning that is itself not disclosing stays.

The texts are parsed once; spans are written to the shared checkpoint folder. Terms are
counted per voice and group before they meet anything. Null, empty and blank fields hold
nothing. Offsets and placeholders are those of the text as given; only what is found is
replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtable.operators.resolve import names_in_texts
from loomtable.operators.skew import join_few
from loomtable.session import cut_lineage

#: Bits from which a term is disclosing. Numbers and addresses are made to tell one person: only what half of all voices share stays.
THRESHOLD_BITS = {"name": 9.0, "email": 1.0, "phone": 1.0, "id_number": 1.0, "address": 1.0}
#: A priori, and worth so many voices: one term in so many is expected in a voice.
PRIOR_VOICES, PRIOR_SHARE = 2048.0, 2.0**-12
#: Share of the most that a term could tell about its group; voices of the group's own distribution that every term is taken to have.
CONCENTRATION, PRIOR_GROUP = 0.8, 4.0
#: Share of the records with a name that have it in a frame, from which its other places are names too.
NAMED_SHARE = 0.5

_WIDE, _NARROW = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　‐‑–—−ｰ", "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " ------"
_FOLD = str.maketrans(_WIDE, _NARROW)
_GONE = "\x00"

_AT_MARK = r"\s?(?:@|[\[(]\s?(?:at|アット|アットマーク)\s?[\])]|アットマーク)\s?"
_DOT = r"\s?(?:\.|[\[(]\s?(?:dot|ドット)\s?[\])])\s?"
EMAIL = re.compile(rf"[A-Za-z0-9](?:[A-Za-z0-9_%+-]|\.(?=[A-Za-z0-9_+-]))*{_AT_MARK}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I)

_NUMBER = r"(?:[A-Z]{1,3}\s?-?)?\d(?:[\d]|[- ](?=\d))*\d"
ID_CUE = (
    r"(?:マイナンバー(?:カード)?|個人番号|学籍番号|生徒番号|学生番号|学生証(?:番号)?|受験番号|パスポート(?:番号)?|旅券(?:番号)?|保険証(?:番号)?|被保険者番号|健康保険(?:番号)?|免許証番号|在留カード番号|基礎年金番号"
    r"|my\s+number|(?:student|pupil|passport|insurance|national|personal|social security|driver'?s licen[cs]e)\s+(?:id|number|no)(?:entity)?(?:\s*(?:number|no))?|passport)"
)
ID_NUMBER = re.compile(rf"{ID_CUE}\.?\s*(?:の?(?:記号|番号))?\s*(?:は|が|:|is|[(\[（])?\s*({_NUMBER})(?:\s*番号\s*({_NUMBER}))?", re.I)
_PLAIN_ID = re.compile(r"(?<![\d-])(?!0\d)\d{4}([- ])\d{4}\1\d{4}(?![\d-])")

_KD = "〇零一二三四五六七八九"
#: Without one of these, or without as many digits as it has at least, a form cannot match.
_CAPITAL = re.compile("[A-Z]")
_AT_SIGN, _DIGIT, _KANJI_DIGITS = re.compile(r"@|(?i:\bat\b)|アット"), re.compile(r"\d"), re.compile(f"[{_KD}]{{2}}")
PHONE = re.compile(
    r"(?<![\d-])(?:\+\d{1,3}[- ]?(?:\(0\))?\d{1,4}[- ]?\d{2,4}[- ]?\d{3,4}|\(0\d{1,4}\)\s?\d{1,4}-?\d{3,4}|0\d{1,4}\s?\(\d{1,4}\)\s?\d{3,4}|0\d{1,4}([-. ])\d{1,4}\1\d{3,4}|0[5789]0\d{8}|0[1-9]\d{8})(?![\d-])"
    rf"|[{_KD}]{{2,4}}[のー-][{_KD}]{{2,4}}[のー-][{_KD}]{{3,4}}"
)

_PLACE_CHAR = re.compile(r"[一-鿿々ヶヵがのしノケ]")
_BLOCK_WORD = re.compile("丁目|番地|番")
#: What stands right before the block of an address: names of places, joined or with blanks.
_PLACE = re.compile(r"(?:〒\s?\d{3}-\d{4}\s?)?(?:[一-鿿々ヶヵがのしノケ]{1,12}[都道府県市区町村郡]\s)*[一-鿿々ヶヵ][一-鿿々ヶヵがのしノケ]{0,24}\s?$")
_N = r"(?:\d{1,4}|[一二三四五六七八九十百]{1,4})"
_BLOCK = rf"(?:{_N}丁目\s?(?:{_N}番地?(?:の?\s?{_N}号?)?|\d{{1,4}}(?:-\d{{1,4}})*)|{_N}番地(?:の?{_N})?|{_N}番{_N}号|\d{{1,3}}-\d{{1,3}}-\d{{1,4}}|\d{{1,3}}の\d{{1,3}}(?:の\d{{1,3}})?)"
_HOUSE = re.compile(r"(?:\s?[一-鿿ァ-ヺー]{2,}[一-鿿ァ-ヺーぁ-ん]*\s?\d{1,4}号室|\s?\d{1,4}号室)?")
BLOCK = re.compile(rf"(?<![\d-]){_BLOCK}(?![\d-])")
ADDRESS = re.compile(
    r"(?:(?:Room|Apt\.?|Apartment|Unit|Flat)\s*#?\d+,?\s*)?\d{1,4}(?:-\d{1,4}){1,2},?\s+[A-Z][a-z]+(?:-(?:cho|machi|ku|shi))?(?:,?\s+[A-Z][a-z]+)*"
    r"|\d{1,5}\s+(?:[A-Z][a-z]+\s+)+(?:Lane|Street|St|Road|Rd|Avenue|Ave|Drive|Court|Way|Terrace|Place|Hill)\b\.?(?:,\s*[A-Z][a-z]+)*(?:\s+\d{3}-\d{4})?"
)

_KJ = r"[一-鿿々]{1,5}(?:[ノヶ][一-鿿々]{1,3})?(?: [一-鿿々]{1,5})?"
_KT = r"[ァ-ヺー]{2,9}(?:[ ・][ァ-ヺー]{2,9})?"
_RM = r"[A-Z][A-Za-z]+(?:[ -][A-Z][A-Za-z]+){0,2}"
_ADDRESSED = r"(?:さん|くん|ちゃん|君|氏|殿|様|っち|先生|教頭|教諭|校長|講師|コーチ|部長|委員長)"
_CALLED = ("さん", "くん", "ちゃん", "君")
_ANY_ADDRESSED = (*_CALLED, "氏", "殿", "様", "っち", "先生", "教頭", "教諭", "校長", "講師", "コーチ", "部長", "委員長")
FRAMES = [
    re.compile(rf"(?<![一-鿿々ヶァ-ヺー])({_KJ})(?={_ADDRESSED})"),
    re.compile(rf"(?<![ァ-ヺー])((?:[一-鿿々]{{1,3}})?{_KT})(?={_ADDRESSED})"),
    re.compile(rf"(?<![A-Za-z])({_RM})(?=\s?{_ADDRESSED})"),
    re.compile(r"(?<=[はが、。「])([ぁ-ん]{3,12}?)(?=(?:さん|くん|ちゃん|君)(?:[はがをにとものでへ、。]|$))"),
    re.compile(rf"(?:私|僕|俺|わたし|ぼく|自分)、\s?({_KJ}|{_KT}|[ぁ-ん]{{3,10}})(?=は|です|と申|が|、|も)"),
    re.compile(rf"[（(](?:文|文責|記|筆者|執筆|取材|写真|聞き手|話し手|担当)\s?[・:/]\s?({_KJ}|{_KT}|{_RM}|[ぁ-ん ]{{3,12}})[）)]"),
    re.compile(r"(?:母|父|姉|兄|弟|妹|祖母|祖父|叔父|叔母|伯父|伯母|娘|息子|友だち|友達|友人|親友|幼なじみ|いとこ)の([一-鿿々]{1,3}(?:[ノの之][一-鿿々]{1,2})?|[ァ-ヺー]{2,8})(?=と|が|は|に|も|や|、|へ)"),
    re.compile(rf"\b(?:Mr|Mrs|Ms|Miss|Dr|Prof|Professor|Coach|Principal)\b\.?\s+({_RM})"),
    re.compile(r"\b(?:[Tt]hanks|[Tt]hank you|[Dd]ear|[Ww]rite to|[Ww]rote to|[Tt]alked (?:to|with)|[Tt]old|[Mm]y friend|[Mm]y (?:brother|sister|mother|father|cousin)|named|called|[Ss]igned),?\s+([A-Z][a-z]+(?:[ ][A-Z](?:\.|[A-Za-z]+))?(?:[ ][A-Z][a-z]+)?)"),
    re.compile(rf"\(({_RM}), class of"),
    re.compile(rf"[—―]\s*({_RM}|{_KJ})\s*$", re.M),
]
#: What a text must have for the frame of the same place to be tried; None for a capital letter.
GATES = [_ANY_ADDRESSED, _ANY_ADDRESSED, _ANY_ADDRESSED, _CALLED, ("私", "僕", "俺", "わたし", "ぼく", "自分"), ("（", "("), ("の",), None, None, ("class of",), ("—", "―")]
#: Words that stand where names stand: forms of address and roles, not the names of anyone.
TITLES = frozenset(
    "皆 皆様 生徒 学生 校長 副校長 理事長 学園長 院長 教頭 担任 副担任 顧問 先輩 後輩 友 友達 仲間 同級生 保護者 母 父 兄 姉 弟 妹 祖父 祖母 お客 お母 お父 監督 部長 副部長 会長 主将 寮長 委員長 神 客 何 誰 各 貴 高校 中学 中学校 小学校 大学 学校 教科 数学 英語 国語 理科 社会 体育 音楽 美術 専任 新任 非常勤"
    " おばあ おじい おかあ おとう おにい おねえ みなみな Teacher Coach Principal English Japanese TEL Tel 連絡先 在住 電話 電話番号 携帯 メール 住所 自宅".split()
)
_NOT_NAME = re.compile(r"○|〇|◯|学園|学院|学校|中学|高校|大学|^(?:the|The|My|I|In|At)$")
#: In a description of a speaker, what ends like a place, a club or a body is none either.
_NOT_PERSON = re.compile(r"(?:市|町|村|県|区|校|部|室|科|会|館|寮|駅|団|班|台|丘|キャンパス)$")


_FOLDED = re.compile(f"[{re.escape(_WIDE)}]")


def fold(text: str) -> str:
    """Narrow forms, one character for one, so that offsets hold."""
    return text.translate(_FOLD) if _FOLDED.search(text) else text


def _blank(text: str, a: int, b: int) -> str:
    return text[:a] + _GONE * (b - a) + text[b:]


def typed_spans(text: str) -> tuple[list[tuple[str, int, int]], str, str]:
    """Spans that have a grammar, the folded text without them, and the folded text."""
    spans: list[tuple[str, int, int]] = []
    folded = rest = fold(text)

    def take(kind: str, pattern: re.Pattern, groups: tuple[int, ...] = (0,), good=lambda s: True) -> None:
        nonlocal rest
        for m in list(pattern.finditer(rest)):
            for g in groups:
                if m.group(g) and good(m.group(g)):
                    spans.append((kind, m.start(g), m.end(g)))
                    rest = _blank(rest, m.start(), m.end())  # with the words that announce it

    numbers = len(_DIGIT.findall(rest))
    if _AT_SIGN.search(rest):
        take("email", EMAIL)
    if numbers >= 4:
        take("id_number", ID_NUMBER, (1, 2), lambda s: sum(c.isdigit() for c in s) >= 4)
    if numbers >= 9 or _KANJI_DIGITS.search(rest):
        take("phone", PHONE, good=lambda s: 9 <= sum(c.isdigit() or c in _KD for c in s) <= 13)
    if numbers >= 12:
        take("id_number", _PLAIN_ID)
    for m in list(BLOCK.finditer(rest)) if numbers or _BLOCK_WORD.search(rest) else ():
        a = m.start()
        while a and (rest[a - 1] in " 〒-" or rest[a - 1].isdigit() or _PLACE_CHAR.match(rest[a - 1])):  # as far back as a place may reach
            a -= 1
        place = _PLACE.search(rest[a : m.start()])
        if place:
            a += place.start()
            if a and rest[a - 1].isdigit() and " " in rest[a : m.start()]:  # the year or class before it
                a = rest.index(" ", a) + 1
            b = _HOUSE.match(rest, m.end()).end()
            spans.append(("address", a, b))
            rest = _blank(rest, a, b)
    if numbers and _CAPITAL.search(rest):
        take("address", ADDRESS)
    return spans, rest, folded


def name_candidates(rest: str, attribute: bool = False) -> list[tuple[str, int, int]]:
    """(term, start, end) of what stands where names stand in a folded text."""
    found: dict[tuple[int, int], str] = {}

    def add(term: str, start: int) -> None:
        lead = len(term) - len(term.lstrip())
        term = term.strip()
        if len(term) >= 2 and term not in TITLES and _GONE not in term and not _NOT_NAME.search(term):
            found[start + lead, start + lead + len(term)] = term

    capital, held = _CAPITAL.search(rest), {}
    for frame, gate in zip(FRAMES, GATES):
        if gate is not None and gate not in held:
            held[gate] = any(w in rest for w in gate)
        if held[gate] if gate else capital:
            for m in frame.finditer(rest):
                add(m.group(1), m.start(1))
    if attribute:  # what is left beside the role
        for m in re.finditer(r"[^()（）・:/,、;\x00]+", rest):
            piece = re.sub(rf"(?:{_ADDRESSED})\s*$", "", m.group(0))
            for p in re.finditer(rf"{_RM}|[一-鿿々]{{2,8}}(?:[ノの之][一-鿿々]{{1,3}})?|[ァ-ヺー]{{3,16}}(?: [ァ-ヺー]{{2,9}})?|(?<![一-鿿々ァ-ヺー])[ぁ-ん]{{4,12}}(?![一-鿿々])", piece):
                inside = piece[p.end() :]
                if not re.match(r"[ぁ-ん一-鿿0-9]", inside) and not re.search(r"[0-9ぁ-ん]$", piece[: p.start()]):
                    if not _NOT_PERSON.search(p.group(0)):
                        add(p.group(0), m.start() + p.start())
    spans = sorted(found, key=lambda s: (s[0], -s[1]))
    kept: list[tuple[str, int, int]] = []
    for a, b in spans:
        if not kept or a >= kept[-1][2]:
            kept.append((found[a, b], a, b))
    return kept


_SPANS = "key bigint, field_name string, voice bigint, entity string, pii_type string, start int, stop int, term string, beginnings array<string>"
_POSTAL = re.compile(r"^〒?\s?\d{3}-\d{4}\s?")
_TOWN = re.compile(r"(?<=[都道府県市区町村郡])")


def _term(kind: str, text: str) -> str:
    """What is counted of a span: names as they stand, forms without blanks, signs and case."""
    return text if kind == "name" else re.sub(r"[\s〒()（）.\[\]-]+", "", text.lower())


SHORT = 40  # characters up to which a text is likely to come again, and what is found in it is kept


def _parsed(text: str, attribute: bool) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], str, str]:
    """(spans that have a grammar, name candidates, the text without the former, the folded text)."""
    typed, rest, folded = typed_spans(text)
    return typed, name_candidates(rest, attribute), rest, folded


_short = lru_cache(50_000)(_parsed)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()))
    names_ = [c.strip().split(" ")[0] for c in _SPANS.split(", ")]
    for batch in batches:
        out: list[tuple] = []
        for key, field, voice, entity, text in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if not text:
                continue
            typed, names, rest, folded = (_short if len(text) <= SHORT else _parsed)(text, field == "speaker_attribute")
            for kind, a, b in typed:
                body = folded[a:b]
                place = _POSTAL.sub("", body)
                cuts = [m.start() for m in _TOWN.finditer(place) if 1 < m.start() < len(place)] if kind == "address" else []
                out.append((key, field, voice, entity, kind, a, b, _term(kind, body), [place[:c] for c in cuts] or None))
            out += [(key, field, voice, entity, "name", a, b, term, None) for term, a, b in names]
            taken = [(a, b) for _, a, b in names]
            for term in {t for t, _, _ in names if len(t) > 2}:  # the same term elsewhere in the field
                out += [(key, field, voice, entity, "name", a, b, term, None) for a, b in occurrences(rest, term) if not any(p < b and a < q for p, q in taken)]
        columns = list(zip(*out)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names_)


def occurrences(text: str, term: str) -> list[tuple[int, int]]:
    return [(m.start(), m.end()) for m in re.finditer(re.escape(term), text)]


_SCRIPTS = [re.compile(r"[一-鿿々]"), re.compile(r"[ァ-ヺー]"), re.compile(r"[ぁ-ん]"), re.compile(r"[A-Za-z]")]


def standing_alone(text: str, term: str) -> list[tuple[int, int]]:
    """Places of a term that no sign of its own script adjoins."""
    own = [next((s for s in _SCRIPTS if s.match(c)), None) for c in (term[0], term[-1])]
    return [
        (a, b)
        for a, b in occurrences(text, term)
        if not (a and own[0] and own[0].match(text[a - 1])) and not (b < len(text) and own[1] and own[1].match(text[b]))
    ]


def _outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of names(term, ...) in the texts they stand in, where none of the spans known is."""
    names_ = ["key", "field_name", "start", "stop", "term"]
    for batch in batches:
        out: list[tuple] = []
        for key, field, text, terms, known in zip(*(batch.column(k).to_pylist() for k in range(5))):
            _, rest, _ = typed_spans(text)
            taken = [(x["start"], x["stop"]) for x in known or []]
            for term in sorted(terms, key=lambda t: (-len(t), t)):
                for a, b in standing_alone(rest, term):
                    if not any(p < b and a < q for p, q in taken):
                        taken.append((a, b))
                        out.append((key, field, a, b, term))
        columns = list(zip(*out)) or [[]] * len(names_)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string()))], names=names_)


def fields_of(df: DataFrame, key: str, fields: list[str], entity: str | None = None) -> DataFrame:
    """(key, field_name, voice, entity, text): one row per record and field that is not null.

    entity names the column of the group a record belongs to (null is a group of its own); a
    voice is what a record says in all fields within its group.
    """
    group = F.coalesce(F.lower(F.trim(F.col(entity))), F.lit("")) if entity else F.lit("")
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields)))
    named = df.select(F.col(key).cast("bigint").alias("__key"), F.xxhash64(group, *fields).alias("__voice"), group.alias("__entity"), pairs.alias("__x"))
    return named.select(F.col("__key").alias("key"), "__x.field_name", F.col("__voice").alias("voice"), F.col("__entity").alias("entity"), "__x.text").filter(F.col("text").isNotNull())


def _bits(n, voices):
    return F.log2((voices + PRIOR_VOICES) / (n + PRIOR_VOICES * PRIOR_SHARE))


def disclosure(spans: DataFrame, rows: DataFrame) -> DataFrame:
    """(pii_type, term, n_voices, bits, concentration) of every term of spans(pii_type, term, voice, entity).

    rows has the voices and entities of the whole corpus. Counts are made per term and group
    first; groups are counted, and meet the counts of terms by measured size.
    """
    groups = cut_lineage(rows.select("voice", "entity").distinct().groupBy("entity").agg(F.count("*").alias("n_group")))
    voices = F.lit(float(groups.agg(F.sum("n_group")).first()[0] or 1))
    met = spans.select("pii_type", "term", "voice", "entity").distinct().groupBy("pii_type", "term", "entity").agg(F.count("*").alias("n"))
    shared = join_few(met, groups, ["entity"], "term")
    totals = shared.groupBy("pii_type", "term").agg(F.sum("n").alias("n_voices"), F.max_by(F.struct("n", "n_group"), F.struct(F.col("n") / F.col("n_group"), F.col("n"))).alias("most"))
    p_group = F.col("most.n_group") / voices
    p_given = (F.col("most.n") + PRIOR_GROUP * p_group) / (F.col("n_voices") + PRIOR_GROUP)
    concentration = F.when(p_group < 1, F.greatest(F.lit(0.0), F.log2(p_given / p_group) / -F.log2(p_group))).otherwise(0.0)
    return totals.select("pii_type", "term", "n_voices", _bits(F.col("n_voices"), voices).alias("bits"), concentration.alias("concentration"))


def is_disclosing(threshold: dict[str, float] | None = None):
    """Condition over (pii_type, n_voices, bits, concentration)."""
    least = F.lit(0.0)
    for kind, bits in (THRESHOLD_BITS | (threshold or {})).items():
        least = F.when(F.col("pii_type") == kind, F.lit(float(bits))).otherwise(least)
    return (F.col("bits") >= least) | ((F.col("concentration") >= CONCENTRATION) & (F.col("n_voices") > 1))


def find_personal_data(rows: DataFrame, threshold: dict[str, float] | None = None) -> DataFrame:
    """(key, field_name, pii_type, start, stop, bits, concentration, keeps) of every span found in rows (see fields_of).

    keeps is the longest beginning of an address, from its place on, that is not disclosing.
    """
    spans = cut_lineage(rows.select("key", "field_name", "voice", "entity", "text").mapInArrow(_spans, _SPANS))
    terms = cut_lineage(disclosure(spans, rows).filter(is_disclosing(threshold)))
    known = spans.join(terms, ["pii_type", "term"]).select("key", "field_name", "pii_type", "start", "stop", "bits", "concentration", "beginnings")
    names = terms.filter("pii_type = 'name'").filter(F.length("term") > 2).select("term", "bits", "concentration")
    # names and places are looked up in all texts, in one pass
    places = spans.filter("beginnings IS NOT NULL").select(F.explode("beginnings").alias("term")).distinct()
    folded = rows.select("key", "field_name", "voice", "entity", _spot().alias("spot"), F.translate("text", _WIDE, _NARROW).alias("text"))
    sought = names.select("term").union(places).distinct()
    met = cut_lineage(names_in_texts(folded, "spot", "text", sought, "term").select(F.col("key").alias("spot"), F.col("name").alias("term")))
    of_places = met.join(places, "term", "left_semi").join(folded.select("spot", "voice", "entity"), "spot").withColumn("pii_type", F.lit("name"))
    shared = disclosure(of_places, rows).filter(~is_disclosing(threshold)).select(F.col("term").alias("place"))
    begun = known.filter("beginnings IS NOT NULL").select("key", "field_name", "start", F.explode("beginnings").alias("place"))
    kept = begun.join(shared, "place").groupBy("key", "field_name", "start").agg(F.max_by("place", F.length("place")).alias("keeps"))
    known = known.drop("beginnings").join(kept, ["key", "field_name", "start"], "left").withColumn("keeps", F.coalesce("keeps", F.lit("")))
    return known.unionByName(_elsewhere(met, folded, spans, names).withColumn("keeps", F.lit("")))




def _spot():
    return F.concat_ws("|", F.col("key").cast("string"), F.col("field_name"))


def _elsewhere(met: DataFrame, folded: DataFrame, spans: DataFrame, names: DataFrame) -> DataFrame:
    """Spans of disclosing names outside of frames, where the name stands mostly in frames."""
    met = met.join(names.select("term"), "term", "left_semi")
    framed = spans.filter("pii_type = 'name'").select(_spot().alias("spot"), "term").distinct()
    share = met.groupBy("term").agg(F.count("*").alias("n_met")).join(framed.groupBy("term").agg(F.count("*").alias("n_framed")), "term").filter(F.col("n_framed") >= NAMED_SHARE * F.col("n_met")).select("term")
    loose = cut_lineage(met.join(framed, ["spot", "term"], "left_anti").join(share, "term", "left_semi").groupBy("spot").agg(F.collect_set("term").alias("terms")))
    taken = spans.withColumn("spot", _spot()).join(loose.select("spot"), "spot", "left_semi").groupBy("spot").agg(F.collect_list(F.struct("start", "stop")).alias("taken"))
    asked = join_few(folded, loose, ["spot"], "key").join(taken, "spot", "left").select("key", "field_name", "text", "terms", "taken")
    more = asked.mapInArrow(_outside, "key bigint, field_name string, start int, stop int, term string")
    return more.join(names, "term").select("key", "field_name", F.lit("name").alias("pii_type"), "start", "stop", "bits", "concentration")


def redact(text: str, spans: list[tuple[str, int, int, str]]) -> str:
    """The text with [TYPE], after what is kept of it, for each span; of overlapping spans the first, and longest, holds."""
    out, at = [], 0
    for kind, a, b, keeps in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"{keeps}[{kind.upper()}]"]
            at = b
    return "".join(out) + text[at:]


def redacted(rows: DataFrame, threshold: dict[str, float] | None = None, generalise: bool = False) -> DataFrame:
    """(key, field_name, text, redacted_text) of rows (see fields_of); untouched texts come out as they are.

    With generalise, an address keeps the beginning that is not disclosing.
    """
    keeps = F.when(F.lit(generalise), F.col("keeps")).otherwise(F.lit(""))
    spans = (
        find_personal_data(rows, threshold)
        .select("key", "field_name", "pii_type", "start", "stop", keeps.alias("keeps"))
        .groupBy("key", "field_name")
        .agg(F.collect_list(F.struct("pii_type", "start", "stop", "keeps")).alias("spans"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            made = [t if not s else redact(t, [(x["pii_type"], x["start"], x["stop"], x["keeps"]) for x in s]) for t, s in zip(texts, found)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.string())], names=["key", "field_name", "text", "redacted_text"])

    return (
        rows.join(spans, ["key", "field_name"], "left")
        .select("key", "field_name", "text", "spans")
        .mapInArrow(run, "key bigint, field_name string, text string, redacted_text string")
    )
