r"""Template residue, filler, error pages and script notices in place of content.

One grammar per delimiter family and one regular expression per kind of notice, all
evaluated as JVM regular expressions inside the scan stage: no Python, no shuffle, one pass.
Grammars have no bound on what stands between their delimiters. From each pattern follows by
rule a set of literals of which every match holds one (`required`); a pattern is tried only
on texts that hold one of its own, which most texts do not.

Before patterns are tried, what a writer only mentions is taken out of the text: quoted
words that are then spoken of (「404」と, "not found"という) and code blocks or spans. A
placeholder in a sentence that explains templates counts only where placeholders make up a
good part of that sentence (MIN_TUTORIAL_DENSITY); in the sentences around it, it counts.

Nulls, empty and blank texts hold no residue and get an empty array of kinds. Repeated
rows are judged alike. Texts are taken whole, however long.
"""

from __future__ import annotations

import re
import re._parser as _sre
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "
#: Full-width brackets stay: they delimit Japanese placeholders.
_KEEP = "（）［］｛｝＜＞"
WIDE = "".join(w for w in _WIDE if w not in _KEEP)
NARROW = "".join(n for w, n in zip(_WIDE, _NARROW) if w not in _KEEP)

MIN_TUTORIAL_DENSITY = 0.2

#: Code, and quoted words that the sentence goes on to speak about.
MENTIONED = "|".join(
    [
        r"(?s)```.*?(?:```|\z)",
        r"`[^`\n]+`",
        r"(?si)<(?:code|pre)>.*?</(?:code|pre)>",
        r"""[「『"“][^「」『』"“”\n]+[」』"”](?=\s*(?:と|という|って|の題|を題|が出|の文字|の表示|で、))""",
        r"""(?i)(?:titled|called|named|entitled|the words?|the phrase|the title|a sign saying|said)\s*["“'‘][^"”\n]+["”'’]""",
    ]
)

#: Words of a sentence that explains templates or code.
TUTORIAL = r"(?i)テンプレート|変数|構文|差し込み印刷|template (?:engine|syntax)|placeholder (?:syntax|is)|for example,? write|variable named|in the code"
#: Where a sentence ends.
SENTENCE = r"(?<=。)|(?<=[.!?])\s+|\n"

PLACEHOLDERS = {
    "double brace": r"\{\{[^{}]*\}\}",
    "brace percent": r"\{%-?[^%{}]+%\}",
    "angle percent": r"<%[=#-]?[^%<>]+%>",
    "processing instruction": r"(?s)<\?(?:php\b|=).*?(?:\?>|\z)",
    "dollar brace": r"[$#]\{\s*[A-Za-z_][\w.]*\s*\}",
    "single brace": r"\{[A-Za-z_][A-Za-z0-9_]+\}",
    "percent": r"%[A-Z][A-Z0-9_]+%",
    "double at": r"@@[A-Za-z_]\w*@@",
    "double underscore": r"__[A-Z][A-Z0-9_]+__",
    "double bracket": r"\[\[[^\[\]\n]+\]\]",
    "short code": r"\[/?[A-Za-z][\w-]*(?:\s+[\w-]+=(?:\"[^\"\n]*\"|'[^'\n]*'|[\w-]+))+\s*/?\]",
    "double angle": r"<<[^<>\n]+>>|&lt;&lt;[^<>&\n]+&gt;&gt;|«[A-Za-z_぀-ヿ一-鿿 ]{2,}»|≪[A-Za-z_぀-ヿ一-鿿 ]{2,}≫",
    "double hash": r"##[^#\n]+##",
    "angle word": r"<[a-z]+(?:_[a-z]+)+>|(?<![\w/])<(?:name|title|year|month|date|school|principal|motto|body|content|message|author|address|class|club)>|&lt;[a-z][a-z_]+&gt;",
    "instruction": r"[【［\[（(〔<＜][^【】［］\[\]（）()〔〕<>＜＞\n]*(?:を(?:入力|記入|記載|挿入|入れる|差し替え)(?:して(?:ください|下さい)?|のこと|予定)?|[がは](?:入り|はいり|入る)(?:ます|予定)?|未設定|未入力|未定義|未記入|未登録)[】］\]）)〕>＞]",
}

#: Words of which any English sentence of some length has one.
FUNCTION_WORDS = "the|of|and|to|in|a|an|is|i|we|you|my|our|it|that|for|with|was|are|as|at|on|be|this|have|not|but|they|he|she|his|her|or|from|by|me|your|their"

DELIMITER = r"[{<\[%@_#&【［（(〔＜≪«$]"

FILLER = {
    "pseudo Latin": r"(?i)lorem\s+ipsum|dolor\s+sit\s+amet|consectetur\s+adipi",
    "sentence of no language": rf"(?:^|[.。!?]\s*|\n\s*)[A-Z][a-z]+(?!(?i:[^.!?\n]*\b(?:{FUNCTION_WORDS})\b))(?:,? [a-z]+){{3,}}\.",
    "filler sentence": r"(?:テキスト|文章|本文|見出し|キャッチコピー|コメント)が(?:入り|はいり|入る)(?:ます)?|ここに(?:文章|本文|テキスト|文|タイトル|見出し|コメント)(?:が|を|[。.\s]|$)|見本文|ダミー(?:テキスト|原稿|文|コピー|データ|です)|※\s*(?:ダミー|仮)|仮の?(?:テキスト|文章|原稿|文です)|サンプル(?:文|テキスト|原稿)|原稿待ち|差し替えてください|正式な原稿|(?i:(?:text|content|your (?:name|text|message)|title) goes here|insert (?:text|your|the) |placeholder text|sample text|dummy text)",
    "repeated character": r"(.)\1{14}(?<![\s\d.。・…—―ー~〜=_*-])",
    "repeated filler": r"(本文|文字|文章|テキスト|テスト|ダミー|サンプル|[a-z]{2,6})\1{3,}",
    "not written yet": r"(?:この|本|当|現在)[^。\n]{0,8}(?:ページ|コンテンツ|記事|サイト|コーナー)[はも][^。\n]{0,12}(?:準備中|作成中|工事中|制作中|編集中|公開予定|更新予定)|(?:^|\n)\s*[（(【\[]?(?:ただいま|現在)?(?:準備中|工事中|作成中|制作中)(?:です|[）)】\]。]|\s*$)|コンテンツは近日|近日(?:公開|掲載)(?:予定|します)|(?i:coming soon|under construction|this page is being|to be (?:announced|determined|added))",
    "bare mark": r"(?i)^\s*(?:tbd|tba|tbc|todo|fixme|n/a|null|nil|none|undefined|nan|test|テスト|未定|未入力|(?:x{3,}))\s*[.。]?\s*$",
}

ERRORS = {
    "status": r"(?i)(?<!\d)[45]\d\d\s*[-:：]?\s*(?:not found|forbidden|bad gateway|internal server error|service (?:temporarily )?unavailable|bad request|unauthorized|gateway time-?out|too many requests|error\b|エラー|ページが|アクセスが)|HTTP\s*(?:エラー|error|status)\s*\d{3}|(?:^|\n)\s*(?:not found|forbidden|bad gateway|internal server error|service unavailable)\s*(?:\n|$)",
    "server": r"(?i:access denied|too many requests|site can.?t be reached|the requested url|something went wrong|page (?:not found|cannot be|could not be)|an error (?:has )?occurred|could not be served|connection (?:refused|timed out))|ERR_[A-Z]+_[A-Z_]+|ERR_TIMED_OUT",
    "program": r"SQLSTATE\[|(?:Warning|Notice|Fatal error|Parse error|Deprecated): \S|Exception in thread|\b[A-Z]\w+(?:Exception|Error): |NullReference|Stack trace|Traceback \(most recent|Undefined (?:variable|index)|\bon line \d+|\{\s*\"(?:error|errors|status|code)\"\s*:",
    "page": r"ページ[はがを][^。\n「」]{0,12}(?:見つかりません|見つかりませんでした|ありません|存在しません|表示できません|表示する権限|削除され)|お探しのページ|(?:エラー|障害)が発生(?:しました|しています)|システムエラー|(?:データベース|サーバー?)[^。\n]{0,6}接続できません|アクセスが(?:拒否|集中して(?:おり|い)ます)|(?:アクセス|閲覧|表示する?)の?権限が(?:ありません|ない)|有効期[限間]が(?:切れ|過ぎ)|再度(?:ログイン|お試し|読み込)|再読み込みして|該当する[^。\n]{1,8}[はが](?:ありません|見つかりません)|URLが変更され|公開期間が終了|メンテナンス中(?:のため|です|につき)|サービスを停止して|管理者にお問い合わせ|(?:恐れ入りますが|時間をおいて)[^。\n]{0,10}(?:お越し|お試し|アクセス)",
}

SCRIPTS = {
    "script": r"(?i)(?:enable|turn on|activate|allow|switch on)\s+(?:java\s*)?(?:scripts?|cookies)|java\s*script\s*[をがは]\s*(?:有効|無効|on\b|off\b|オン|オフ|許可)|java\s*script\s+(?:is|must be|has been|seems to be)|requires?\s+java\s*script|<noscript|スクリプト[をがのは][^。\n]{0,10}(?:許可|有効|無効|使用して|実行)",
    "cookie": r"(?i)(?:クッキー|cookie)s?[をがのはと][^。\n]{0,20}(?:許可|有効|無効|使用して|同意|必要)|we use cookies|accept (?:all )?cookies|cookies? (?:is|are|must be) (?:required|disabled|blocked)",
    "browser": r"(?i)お使いの(?:ブラウザ|環境|端末)|ブラウザの(?:設定|更新|バージョン)|(?:ご覧|ご利用)の環境では|動的コンテンツ|ブラウザ[^。\n]{0,8}(?:サポート|対応して|推奨)|最新版に更新|your browser|unsupported browser|コンテンツを読み込んでいます|^\s*(?:now )?loading\s*(?:\.{2,}|…)",
}

KINDS = {"placeholder": PLACEHOLDERS, "filler": FILLER, "error": ERRORS, "script": SCRIPTS}


def _best(sets: list[frozenset[str] | None]) -> frozenset[str] | None:
    """Of several sets of which each has a literal of every match, the most telling."""
    return max((x for x in sets if x), key=lambda x: (min(map(len, x)), -len(x)), default=None)


def _required(tree) -> frozenset[str] | None:
    found, run = [], ""
    for op, value in [*tree, (None, None)]:
        if op is _sre.LITERAL:
            run += chr(value)
            continue
        if run:
            found.append(frozenset([run]))
            run = ""
        if op is _sre.SUBPATTERN:
            found.append(_required(value[3]))
        elif op is _sre.BRANCH:
            parts = [_required(x) for x in value[1]]
            found.append(frozenset().union(*parts) if all(parts) else None)
        elif op in (_sre.MAX_REPEAT, _sre.MIN_REPEAT) and value[0] > 0:
            found.append(_required(value[2]))
        elif op is _sre.IN and all(kind is _sre.LITERAL for kind, _ in value):
            found.append(frozenset(chr(c) for _, c in value))
    return _best(found)


def required(pattern: str) -> frozenset[str] | None:
    """Literals, in small letters, of which every match of a pattern holds one; None if there are none."""
    found = _required(_sre.parse(pattern.replace(r"\z", r"\Z")))
    return frozenset(x.lower() for x in found) if found else None


def alternatives(pattern: str) -> list[str]:
    """The top-level alternatives of a pattern, each with the flags that begin it."""
    flags = re.match(r"\(\?[a-z]+\)", pattern)
    flag, body = (flags.group(0), pattern[flags.end() :]) if flags else ("", pattern)
    out, depth, start, k, in_class = [], 0, 0, 0, False
    while k < len(body):
        c = body[k]
        if c == "\\":
            k += 1
        elif in_class:
            in_class = c != "]" or k == opened + 1
        elif c == "[":
            in_class, opened = True, k
        elif c == "|" and depth == 0:
            out.append(flag + body[start:k])
            start = k + 1
        else:
            depth += (c == "(") - (c == ")")
        k += 1
    return [*out, flag + body[start:]]


#: What has no three Latin letters in a row cannot match a pattern of Latin letters only.
LATIN = r"[A-Za-z]{3}"


def _any_of(said: Column, low: Column, patterns: list[str]) -> Column:
    """Whether any pattern matches; each is tried behind the literals that it requires."""
    hit = F.lit(False)
    gated: dict[str, list[str]] = {}
    for pattern in (a for p in patterns for a in ([p] if "\\1" in p else alternatives(p))):
        literals = required(pattern)
        if literals and min(map(len, literals)) > 1:
            gated.setdefault("|".join(map(re.escape, sorted(literals))), []).append(pattern)
        else:  # a sign or two as a gate; back references keep their own groups
            one = [low.contains(x) for x in sorted(literals or ())]
            gate = reduce(or_, one) if one else F.lit(True)
            hit = hit | (gate & said.rlike(pattern))
    if gated:
        literals = sorted({x for p in gated.values() for a in p for x in required(a)})
        least = [x for x in literals if not any(y != x and y in x for y in literals)]  # what holds a longer one holds it too
        hit = hit | (reduce(or_, [low.contains(x) for x in least]) & said.rlike("|".join(f"(?:{a})" for p in gated.values() for a in p)))
    return hit


def spoken(text: Column) -> Column:
    """The text with narrow forms, without what it only mentions."""
    return F.regexp_replace(F.translate(text, WIDE, NARROW), MENTIONED, "◇")


_ANY_PLACEHOLDER = "|".join(f"(?:{p})" for p in PLACEHOLDERS.values())


def residue_kinds(text: Column) -> Column:
    """Sorted array of the kinds found: 'error', 'filler', 'placeholder', 'script'."""

    def kinds(said: Column, low: Column) -> Column:
        hits = {kind: _any_of(said, low, list(patterns.values())) for kind, patterns in KINDS.items() if kind not in ("placeholder", "filler")}
        foreign = FILLER["sentence of no language"]
        hits["filler"] = _any_of(said, low, [p for n, p in FILLER.items() if n != "sentence of no language"]) | (said.rlike(LATIN) & said.rlike(foreign))
        meant = lambda s: s.rlike(_ANY_PLACEHOLDER) & (~s.rlike(TUTORIAL) | (placeholder_density(s) >= MIN_TUTORIAL_DENSITY))
        found = said.rlike(DELIMITER) & said.rlike(_ANY_PLACEHOLDER)
        hits["placeholder"] = found & (~said.rlike(TUTORIAL) | F.exists(F.split(said, SENTENCE), meant))
        return F.array_compact(F.array(*(F.when(hits[kind], F.lit(kind)) for kind in sorted(KINDS))))

    # bound as a lambda's variable, what is said is worked out once per row, not once per pattern
    both = F.transform(F.array(spoken(text)), lambda said: F.struct(said.alias("said"), F.lower(said).alias("low")))
    found = F.get(F.transform(both, lambda x: kinds(x.said, x.low)), F.lit(0))
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(found)


def placeholder_density(said: Column) -> Column:
    """Share of the characters that stand in placeholders."""
    rest = F.regexp_replace(said, _ANY_PLACEHOLDER, "")
    return F.when(F.length(said) > 0, 1 - F.length(rest) / F.length(said)).otherwise(0.0)


def find_residue(df: DataFrame, text: str, into: str = "residue_kinds") -> DataFrame:
    """df with an array column of the kinds of residue in `text`; a column of that name is replaced."""
    return df.withColumn(into, residue_kinds(F.col(text)))


def without_residue(df: DataFrame, text: str) -> DataFrame:
    """The rows of df whose text holds no residue; rows with a null text stay."""
    return df.filter(F.size(residue_kinds(F.col(text))) == 0)
