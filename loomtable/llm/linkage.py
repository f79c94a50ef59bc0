"""Records of two sources matched without a common key, with a confidence for each match.

Claims name a school in their own way and describe it in a snippet; the master has names in
several spellings and some attributes. Both are parsed into the same parts. Claims meet the
schools whose core name, written or as it sounds, is theirs or has one character more (an
equi-join on the core), and each pair becomes a vector of similarities: core, kind of school, level, town, prefecture,
founding year, operator, pupils. What one side does not say is missing, not different.

A mixture of two Gaussians with diagonal covariance, one for matched and one for unmatched
vectors, is fitted without labels by expectation-maximisation; missing parts are integrated
out, variances and weights are regularised by priors. The expectation step keeps to
transitivity: all that a claim is matched with must be one school, so the odds of its
candidates, and of there being none, share one unit of probability. Posteriors are the
confidences.

Scale: claims with the same bundle of vectors are counted once, so an iteration of EM goes
over distinct bundles, with sums of a few dozen numbers as its only result. A bundle holds
the candidates of one claim, as many as there are schools of one name. Claims without any
name or candidate, and those of other kinds of institution, have no match. Nulls in any
column are missing parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtable.llm.confusables import skeletons
from loomtable.session import cut_lineage

PARTS = ["core", "kind", "level", "town", "prefecture", "year", "operator", "pupils"]
TOLERANCE = 1e-5  # change of any mean, deviation or weight at which EM has converged
BUNDLES_PER_TASK = 50_000  # distinct bundles that a task goes over in a step of EM
LEAST_CONFIDENCE = 0.5
#: Priors: pseudo-counts of variance and weight.
PRIOR_VARIANCE, PRIOR_COUNT = 0.03, 5.0

#: Old forms of ideographs before the new ones.
_OLD = "學学國国澤沢峯峰濱浜嶋島邊辺廣広齋斎髙高櫻桜龍竜瀧滝惠恵榮栄眞真藏蔵彌弥壽寿圓円會会豐豊應応靈霊聲声舊旧黑黒德徳晉晋淺浅條条縣県鷗鴎祿禄莊荘萬万號号實実嶽岳﨑崎嵜崎𠮷吉靑青"
_NEW = str.maketrans(dict(zip(_OLD[::2], _OLD[1::2])))

#: Syllables and their Hepburn spelling, small signs handled by rule.
_SYLLABLES = (
    "あ a い i う u え e お o か ka き ki く ku け ke こ ko さ sa し shi す su せ se そ so た ta ち chi つ tsu て te と to な na に ni ぬ nu ね ne の no "
    "は ha ひ hi ふ fu へ he ほ ho ま ma み mi む mu め me も mo や ya ゆ yu よ yo ら ra り ri る ru れ re ろ ro わ wa ゐ i ゑ e を o ん n "
    "が ga ぎ gi ぐ gu げ ge ご go ざ za じ ji ず zu ぜ ze ぞ zo だ da ぢ ji づ zu で de ど do ば ba び bi ぶ bu べ be ぼ bo ぱ pa ぴ pi ぷ pu ぺ pe ぽ po ゔ vu"
).split()
_ROMAN = dict(zip(_SYLLABLES[::2], _SYLLABLES[1::2]))


def hiragana(text: str) -> str:
    return "".join(chr(ord(c) - 0x60) if "ァ" <= c <= "ヶ" else c for c in text)


def romanised(kana: str) -> str:
    """Hepburn spelling of kana, long vowels written out; signs outside the syllabary are dropped."""
    out = ""
    double = False
    for c in hiragana(kana):
        if c == "っ":
            double = True
        elif c == "ー":
            out += out[-1:] if out[-1:] in "aiueo" else ""
        elif c in "ゃゅょ":
            stem, vowel = out[:-1], {"ゃ": "a", "ゅ": "u", "ょ": "o"}[c]
            out = stem + vowel if stem.endswith(("sh", "ch", "j")) else stem + "y" + vowel
        elif c in "ぁぃぅぇぉ":
            out = out[:-1] + {"ぁ": "a", "ぃ": "i", "ぅ": "u", "ぇ": "e", "ぉ": "o"}[c] if out else out
        elif c in _ROMAN:
            syllable = _ROMAN[c]
            out += ("t" if syllable.startswith("ch") else syllable[0]) + syllable if double else syllable
            double = False
    return out


def sound(roman: str) -> str:
    """A Latin spelling without what writers treat differently: long vowels, doubled signs, n before b, m, p."""
    s = re.sub(r"[^a-z0-9]", "", roman.lower())
    s = re.sub(r"ou|oo|oh(?=[^aiueo]|$)", "o", s).replace("uu", "u")
    s = re.sub(r"m(?=[bmp])", "n", s)
    return re.sub(r"([^aiueo\d])\1", r"\1", s)


_OTHER = re.compile(r"大学|小学校|小学部|初等部|高等学校|高校|高等部|幼稚園|保育園|専門学校|短大|大学院|高専|しょうがっこう|こうとうがっこう|こうこう$|ようちえん|(?i:univ|college|elementary|primary|kindergarten|(?<!junior )(?:senior )?high school)")
_LEVELS = [("中等教育学校", "six"), ("ちゅうとうきょういくがっこう", "six"), ("中等教育学", "six"), ("中等教育校", "six"), ("中等部", "part"), ("ちゅうとうぶ", "part"), ("中学校", "junior"), ("ちゅうがっこう", "junior"), ("中学", "junior"), ("中校", "junior"), ("中", "junior"), ("学校", ""), ("がっこう", "")]
_BASES = {"学院": "院", "学園": "園", "学舎": "舎", "義塾": "塾", "がくいん": "院", "がくえん": "園", "がくしゃ": "舎", "ぎじゅく": "塾", "院": "院", "園": "園", "舎": "舎", "塾": "塾", "学": "学"}
#: With one character lost.
_LEVELS += [(v, level) for end, level in _LEVELS if len(end) >= 4 for v in dict.fromkeys(end[:k] + end[k + 1 :] for k in range(len(end))) if v not in dict(_LEVELS)]
_LEVELS.sort(key=lambda x: -len(x[0]))
_BASES["義"] = "塾"
#: A university as it sounds; いん, えん and しゃ after it belong to a school's base (…台学院, …台学園, …台学舎).
_UNIVERSITY_KANA = re.compile(r"だいがく(?!いん|えん|しゃ)")
_LATIN_LEVELS = [("junior high school", "junior"), ("secondary school", "six"), ("chutokyoikugakko", "six"), ("chutobu", "part"), ("chugakko", "junior"), ("junior high", "junior"), ("middle school", "junior"), ("school", "")]
_LATIN_BASES = {"gakuin": "院", "gakuen": "園", "gakusha": "舎", "gijuku": "塾", "academy": "園"}


def _cut_end(text: str, ends) -> tuple[str, str | None]:
    for end in ends:
        if text.endswith(end) and len(text) > len(end):
            return text[: -len(end)], end
    return text, None


def _of_other_kind(text: str) -> bool:
    """Whether the name is one of another kind of institution; as it sounds, a university has no level of a school at its end."""
    if _OTHER.search(text):
        return True
    return bool(_UNIVERSITY_KANA.search(text)) and not dict(_LEVELS).get(_cut_end(text, [e for e, _ in _LEVELS])[1])


def parse_name(name: str) -> dict | None:
    """The parts of a school's name, already in its consistent form; None if another kind of institution or nothing."""
    s = name.translate(_NEW).strip()
    notes = re.findall(r"[（(]([^）)]*)[）)]", s)
    s = re.sub(r"[（(][^）)]*[）)]", "", s).strip()
    operator = re.match(r"学校法人\s*(\S+)(?:\s+|$)", s)
    if operator and operator.end() < len(s):
        s = s[operator.end() :]
    s = re.sub(r"^旧制\s*", "", s)
    s = re.sub(r"高等女学校$", "中学校", s)
    s = re.sub(r"^(?:私立|市立|県立|国立|公立|学校法人)\s*", "", s)
    if not s or _of_other_kind(s):
        return None
    out = {"kind": None, "level": None, "where": next((n for n in notes if n not in ("休校", "閉校", "旧", "仮")), None), "operator": operator.group(1) if operator else None}
    if re.fullmatch(r"[A-Za-z .'\-ōūāēī]+", s):
        low = re.sub(r"[.'\-]", "", s.lower().translate(str.maketrans("ōūāēī", "ouaei")))
        low, level = _cut_end(low, [e for e, _ in _LATIN_LEVELS])
        low = low.strip()
        low, girls = re.sub(r"\bgirls\b", "", low).strip(), "女" if re.search(r"\bgirls\b|\bjo(?=gak)", low) else ""
        words_ = re.sub(r"\bjo(?=gak)", "", low).split()
        base = _LATIN_BASES.get(words_[-1]) if len(words_) > 1 else None
        if base:
            words_ = words_[:-1]
        world = len(words_) > 1 and words_[-1] in ("kokusai", "international")
        if world:
            words_ = words_[:-1]
        out |= {"level": dict(_LATIN_LEVELS).get(level) or None, "kind": f"{girls}|{'国' if world else ''}|{base or ''}" if base or world or level else None, "keys": ["s:" + sound("".join(words_))]}
        return out
    s = re.sub(r"\s+", "", s)
    s, level = _cut_end(s, [e for e, _ in _LEVELS])
    s, base = _cut_end(s, _BASES)
    s, girls = _cut_end(s, ["女", "女子", "じょ"]) if base else (s, None)
    s, world = _cut_end(s, ["国際", "こくさい"])
    out["level"] = dict(_LEVELS).get(level) or None
    out["kind"] = f"{'女' if girls else ''}|{'国' if world else ''}|{_BASES.get(base, '')}" if base or world or level else None
    s = re.sub(r"(?<=[一-鿿])[ヶケヵがガ](?=[一-鿿])", "ヶ", s)
    s = re.sub(r"(?<=[一-鿿])[ノの之乃](?=[一-鿿])", "ノ", s)
    out["keys"] = ["t:" + s.lower()]
    if re.fullmatch(r"[ぁ-んァ-ヶー]+", s):
        out["keys"].append("s:" + sound(romanised(s)))
    return out


_ERAS = {"明治": 1867, "大正": 1911, "昭和": 1925, "平成": 1988, "令和": 2018}
_CITED = re.compile(r"(?:である|の)?([^、。「」]{2,40}?)(?:に学んだ|で学んだ|を卒業した|へ通った|に通った|で教鞭をとった|に在籍し|の設立に加わった|を設立した|に勤めた)")


def parse_snippet(text: str) -> dict:
    """What a snippet says of the school; its first sentence with a school in it counts."""
    out: dict = {"year": None, "place": None, "operator": None, "pupils": None, "cited": None}
    t = text.translate(_NEW)
    year = re.search(r"(?:(明治|大正|昭和|平成|令和)(\d{1,2}|元)年|(?<!\d)(1[6-9]\d\d|20\d\d)年)(?:創立|創設|設立|に(?:開かれ|創立|創設|設立|開校)|開校)|(?:創設|創立|設立|開校)は(?:(明治|大正|昭和|平成|令和)(\d{1,2}|元)年|(1[6-9]\d\d|20\d\d)年)", t)
    if year:
        era, n, west = (year.group(1), year.group(2), year.group(3)) if year.group(1) or year.group(3) else (year.group(4), year.group(5), year.group(6))
        out["year"] = int(west) if west else _ERAS[era] + (1 if n == "元" else int(n))
    operator = re.search(r"学校法人([^、。「」\s]+?)(?:である|の学校|が|、|。|$)", t)
    if operator:
        out["operator"] = operator.group(1)
    for word, kind in (("共学", "coed"), ("男子校", "boys"), ("女子校", "girls")):
        if re.search(rf"(?:^|[、。「はに]){word}(?:である|、|。|の|$)", t):
            out["pupils"] = kind
    place = re.search(r"(?:^|[、。「]|には|よれば、)([一-鿿々ヶノが]{2,14}?)(?:にあった|の学校|で少年期|に位置|、(?:\d{4}|明治|大正|昭和|平成|令和)[^、。]{0,6}年?創立の学校)", t)
    if place:
        out["place"] = place.group(1)
    cited = _CITED.search(t)
    if cited:
        name = re.sub(r"^.*(?:である|には|によれば)", "", cited.group(1))
        if name not in ("同校", "母校", "この学校") and not re.search(r"創立|創設|経営は|少年期", name):
            out["cited"] = name
    return out


def _claims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = ["key", "keys", "kind", "level", "place", "year", "operator", "pupils"]
    for batch in batches:
        names = skeletons([x or "" for x in batch.column(1).to_pylist()], True)
        snippets = skeletons([x or "" for x in batch.column(2).to_pylist()], True)
        rows = []
        for key, name, snippet in zip(batch.column(0).to_pylist(), names, snippets):
            said = parse_snippet(snippet)
            parsed = parse_name(name) if name.strip() else None
            if parsed is None and not name.strip() and said["cited"]:
                parsed = parse_name(said["cited"])
            if parsed is None:
                continue
            where = said["place"] or parsed["where"]
            rows.append((key, parsed["keys"], parsed["kind"], parsed["level"], where, said["year"], said["operator"] or parsed["operator"], said["pupils"]))
        columns = list(zip(*rows)) or [[] for _ in fields]
        kinds = [pa.int64(), pa.list_(pa.string()), *[pa.string()] * 3, pa.int32(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=fields)


_CLAIM_SCHEMA = "key bigint, keys array<string>, kind string, level string, place string, year int, operator string, pupils string"


def _master(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = ["school_id", "text_key", "sound_key", "s_kind", "s_level", "s_town", "s_prefecture", "s_year", "s_operator", "s_pupils"]
    for batch in batches:
        col = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        alike = lambda c: [x.translate(_NEW) or None for x in skeletons([v or "" for v in col[c]], True)]
        names = skeletons([x or "" for x in col["name"]], True)
        towns, prefectures, operators = alike("town"), alike("prefecture"), alike("operator")
        rows = []
        for k, name in enumerate(names):
            parsed = parse_name(name)
            if parsed is None:
                continue
            kana = parse_name(skeletons([col["kana"][k] or ""], True)[0]) if col["kana"][k] else None
            keys = parsed["keys"] + (kana["keys"] if kana else [])
            operator = (operators[k] or "").removeprefix("学校法人") or None
            text_key = next((x for x in keys if x.startswith("t:")), None)
            sound_key = next((x for x in keys if x.startswith("s:")), None)
            rows.append((col["id"][k], text_key, sound_key, parsed["kind"], parsed["level"], towns[k], prefectures[k], col["year"][k], operator, col["pupils"][k]))
        columns = list(zip(*rows)) or [[] for _ in fields]
        kinds = [pa.string()] * 7 + [pa.int32(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=fields)


def parsed_claims(claims: DataFrame, key: str, name: str, snippet: str) -> DataFrame:
    return claims.select(F.col(key).cast("bigint"), F.col(name), F.col(snippet)).mapInArrow(_claims, _CLAIM_SCHEMA)


def parsed_master(master: DataFrame) -> DataFrame:
    """master(id, name, kana, town, prefecture, year, operator, pupils); one row per key and distinct description.

    A row without a reading takes those of the other rows with the same written core.
    """
    rows = master.select("id", "name", "kana", "town", "prefecture", F.col("year").cast("int").alias("year"), "operator", "pupils").mapInArrow(
        _master, "school_id string, text_key string, sound_key string, s_kind string, s_level string, s_town string, s_prefecture string, s_year int, s_operator string, s_pupils string"
    )
    known = rows.filter("sound_key IS NOT NULL").select("text_key", F.col("sound_key").alias("other_sound")).distinct()
    full = rows.join(known, "text_key", "left").withColumn("sound_key", F.coalesce("sound_key", "other_sound"))
    core = F.substring("text_key", 3, 1000)
    shorter = F.when(
        F.length(core) >= 2,
        F.transform(F.sequence(F.lit(1), F.length(core)), lambda k: F.concat(F.lit("d:"), F.substring(core, F.lit(1), k - 1), F.substring(core, k + 1, F.lit(1000)))),
    )
    blocks = F.array_union(F.array("text_key", "sound_key"), F.coalesce(shorter, F.array().cast("array<string>")))
    return full.select(F.explode(blocks).alias("block"), *[c for c in rows.columns if c not in ("text_key", "sound_key")]).filter("block IS NOT NULL").distinct()


def compared(claims: DataFrame, schools: DataFrame) -> DataFrame:
    """(key, school_id, one column per part): the best each school's rows offer; null is missing."""
    blocks = F.flatten(F.transform("keys", lambda k: F.when(k.startswith("t:"), F.array(k, F.concat(F.lit("d:"), F.substring(k, 3, 1000)))).otherwise(F.array(k))))
    pairs = claims.withColumn("block", F.explode(blocks)).drop("keys").join(schools, "block")
    same = lambda a, b: F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), (F.col(a) == F.col(b)).cast("double"))
    bit = lambda k: (F.split("kind", r"\|")[k] == F.split("s_kind", r"\|")[k]).cast("double")
    base, s_base = F.split("kind", r"\|")[2], F.split("s_kind", r"\|")[2]
    bases = F.when(base == s_base, 1.0).when((base == "学") & s_base.isin("院", "園", "舎"), 0.8).otherwise(0.0)
    kind = F.when(F.col("kind").isNotNull() & F.col("s_kind").isNotNull(), (bit(0) + bit(1) + bases) / 3)
    stem = F.regexp_replace("s_prefecture", "[都道府県]$", "")
    place = F.col("place")
    has_town = place.rlike("[市町村区]")
    town = F.when(place.isNotNull() & F.col("s_town").isNotNull() & has_town, F.when(place.endswith(F.col("s_town")) & (place.isin(F.col("s_town")) | F.coalesce(place.startswith(stem), F.lit(True))), 1.0).otherwise(0.0))
    names_it = place.startswith(stem) & (F.length(place) >= F.length(stem))
    only_town = has_town & F.coalesce(place == F.col("s_town"), F.lit(False))
    other = ~has_town | F.coalesce(place.endswith(F.col("s_town")), F.lit(False)) | place.contains("県")
    prefecture = F.when(place.isNotNull() & F.col("s_prefecture").isNotNull(), F.when(names_it, 1.0).when(only_town, None).when(other, 0.0))
    gap = F.abs(F.col("year") - F.col("s_year"))
    year = F.when(gap == 0, 1.0).when(gap <= 1, 0.7).when(gap.isNotNull(), 0.0)
    core = F.when(F.col("block").startswith("d:"), 0.0).otherwise(1.0)
    parts = pairs.select("key", "school_id", core.alias("core"), kind.alias("kind"), same("level", "s_level").alias("level"), town.alias("town"), prefecture.alias("prefecture"), year.alias("year"), same("operator", "s_operator").alias("operator"), same("pupils", "s_pupils").alias("pupils"))
    return parts.groupBy("key", "school_id").agg(*(F.max(p).alias(p) for p in PARTS))


class Mixture:
    """Two diagonal Gaussians over vectors with missing parts; component 1 is the matched one."""

    def __init__(self):
        self.weight = 0.3
        self.mean = np.array([[0.8, 0.6, 0.6, 0.2, 0.3, 0.1, 0.3, 0.5], [0.95] * len(PARTS)])
        self.variance = np.full((2, len(PARTS)), 0.1)
        self.steps = 0

    def parameters(self) -> np.ndarray:
        return np.r_[self.mean.ravel(), np.sqrt(self.variance).ravel(), self.weight]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        there = ~np.isnan(x)
        filled = np.where(there, x, 0)
        part = [np.where(there, -0.5 * np.log(self.variance[c]) - (filled - self.mean[c]) ** 2 / (2 * self.variance[c]), 0).sum(1) for c in (0, 1)]
        return np.log(self.weight / (1 - self.weight)) + part[1] - part[0]

    def posteriors(self, x: np.ndarray, claim: np.ndarray) -> np.ndarray:
        """Of each pair; pairs of a claim, and no match at all, exclude each other."""
        odds = np.exp(np.clip(self.log_odds(x), -50, 50))
        total = np.bincount(claim, odds)
        return odds / (1 + total[claim])

    def sums(self, x: np.ndarray, claim: np.ndarray, n: np.ndarray) -> np.ndarray:
        p = self.posteriors(x, claim)
        there = ~np.isnan(x)
        filled = np.where(there, x, 0)
        out = []
        for r in ((1 - p) * n, p * n):
            out += [np.r_[r.sum(), np.zeros(len(PARTS) - 1)], (r[:, None] * there).sum(0), (r[:, None] * filled).sum(0), (r[:, None] * filled**2).sum(0)]
        return np.array(out)

    def update(self, sums: np.ndarray) -> None:
        total = sums[0, 0] + sums[4, 0]
        self.weight = float(np.clip((sums[4, 0] + 1) / (total + 2), 1e-4, 1 - 1e-4))
        for c in (0, 1):
            n, first, second = sums[4 * c + 1], sums[4 * c + 2], sums[4 * c + 3]
            prior = (0.5, 0.95)[c]
            mean = (first + PRIOR_COUNT * prior) / (n + PRIOR_COUNT)
            spread = second - 2 * mean * first + n * mean**2
            self.mean[c] = mean
            self.variance[c] = (spread + PRIOR_COUNT * PRIOR_VARIANCE) / (n + PRIOR_COUNT)
            self.variance[c] = np.maximum(self.variance[c], 0.004)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    bundles = batch.column(0)
    claim = np.repeat(np.arange(len(bundles)), np.diff(bundles.offsets.to_numpy()))
    values = bundles.flatten()
    x = np.stack([values.field(k).to_numpy(zero_copy_only=False).astype(float) for k in range(len(PARTS))], 1)
    return x, claim


def fitted(pairs: DataFrame) -> Mixture:
    """The mixture fitted to all pairs, until EM has converged; `steps` tells after how many steps."""
    bundles = cut_lineage(
        pairs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(*PARTS))).alias("bundle")).groupBy("bundle").agg(F.count("*").alias("n"))
    )
    bundles = bundles.coalesce(max(1, bundles.count() // BUNDLES_PER_TASK))
    mixture = Mixture()
    while True:

        def step(batches: Iterator[pa.RecordBatch], m: Mixture = mixture) -> Iterator[pa.RecordBatch]:
            total = np.zeros((8, len(PARTS)))
            for batch in batches:
                x, claim = _flat(batch)
                if len(x):
                    total += m.sums(x, claim, batch.column(1).to_numpy()[claim].astype(float))
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["sums"])

        parts = bundles.mapInArrow(step, "sums array<double>").collect()  # 64 numbers per BUNDLES_PER_TASK bundles
        if not parts:
            return mixture
        before = mixture.parameters()
        mixture.update(np.sum([r.sums for r in parts], 0).reshape(8, len(PARTS)))
        mixture.steps += 1
        if np.abs(mixture.parameters() - before).max() < TOLERANCE:
            return mixture


def matches(claims: DataFrame, key: str, name: str, snippet: str, master: DataFrame, least: float = LEAST_CONFIDENCE) -> DataFrame:
    """(key, school_id, confidence): of each claim the school it means, where one is likely enough.

    The least confidence is above one half at most once per claim.
    """
    pairs = cut_lineage(compared(parsed_claims(claims, key, name, snippet), parsed_master(master)))
    m = fitted(pairs)
    odds = F.lit(float(np.log(m.weight / (1 - m.weight))))
    for k, p in enumerate(PARTS):
        x = F.col(p)
        (m0, m1), (v0, v1) = m.mean[:, k].tolist(), m.variance[:, k].tolist()
        ratio = 0.5 * float(np.log(v0 / v1)) - (x - m1) ** 2 / (2 * v1) + (x - m0) ** 2 / (2 * v0)
        odds = odds + F.coalesce(ratio, F.lit(0.0))
    scored = pairs.withColumn("odds", F.exp(F.least(F.greatest(odds, F.lit(-50.0)), F.lit(50.0))))
    own = Window.partitionBy("key")
    scored = scored.withColumn("confidence", F.col("odds") / (1 + F.sum("odds").over(own)))
    return scored.filter(F.col("confidence") > least).select("key", "school_id", F.round("confidence", 6).alias("confidence"))
