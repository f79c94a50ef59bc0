"""Documents to rows: markup, Markdown, wiki text and facts in prose.

What regular expressions can say is a column expression (tags, quoted spans, question and
answer, links, facts). What needs a document's structure is parsed by the standard library's
parser, one document at a time inside Arrow batches (mapInArrow): rows are emitted as they
are found, nothing is grouped or shuffled. Null and empty documents give no rows; broken
markup is parsed as far as it goes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtable.functions.text import strip_html

# ---- by expression


def tag_contents(html: Column, tags: list[str]) -> Column:
    """array(struct(tag, body)): the plain text of each element of the tags, in order of tag and place."""
    named = lambda t: lambda body: F.struct(F.lit(t).alias("tag"), strip_html(body).alias("body"))
    parts = [F.transform(F.regexp_extract_all(html, F.lit(rf"(?is)<{t}(?:\s[^>]*)?>(.*?)</{t}>"), F.lit(1)), named(t)) for t in tags]
    return F.flatten(F.array(*parts))


def any_element(html: Column) -> Column:
    """Plain texts of the innermost elements of any tag; the closing tag must be that of the opening one."""
    return F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<([a-z][a-z0-9]*)(?:\s[^>]*)?>([^<]*)</\1>"), F.lit(2)), lambda b: strip_html(b))


def quoted_spans(text: Column, least: int = 5, most: int = 200) -> Column:
    return F.regexp_extract_all(text, F.lit(f"「([^「」\\n]{{{least},{most}}})」"), F.lit(1))


def questions_and_answers(text: Column) -> Column:
    """array(struct(question, answer)) of lines that begin with Q and A."""
    pair = r"(?m)^Q[:：]\s*([^\n]*)\nA[:：]\s*([^\n]*)"
    qs, answers = (F.regexp_extract_all(text, F.lit(pair), F.lit(k)) for k in (1, 2))
    return F.arrays_zip(qs.alias("question"), answers.alias("answer"))


def links(html: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r"(?i)<a\s[^>]*href=[\"']([^\"'#]+)"), F.lit(1)))


def rule_hits(df: DataFrame, key: str, text: str, rules: list[tuple[str, str]], most: int) -> DataFrame:
    """(key, label, value, snippet): of each rule (label, pattern with one group) the first hit, at most `most` per row in order of the rules."""
    t = F.col(text)
    hits = F.array_compact(
        F.array(
            *(
                F.when(t.rlike(p), F.struct(F.lit(label).alias("label"), F.regexp_extract(t, p, 1).alias("value"), F.regexp_extract(t, f"(.{{0,20}}(?:{p}).{{0,20}})", 1).alias("snippet")))
                for label, p in rules
            )
        )
    )
    return df.select(F.col(key), F.explode(F.slice(hits, 1, most)).alias("h")).select(key, "h.label", "h.value", "h.snippet")


def plausible(value: Column, low: int, high: int) -> Column:
    """The number, or null outside its bounds."""
    n = F.regexp_replace(value, ",", "").try_cast("int")
    return F.when(n.between(low, high), n)


# ---- by parser


def _emit(df: DataFrame, key: str, text: str, schema: str, parse: Callable[[str], list[tuple]]) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()
    names = [p.strip().split(" ")[0] for p in schema.split(",")]
    kinds = [pa.int32() if p.strip().endswith(" int") else pa.string() for p in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = parse(t) if t else []
                ids += [k] * len(found)
                rows += found
            columns = list(zip(*rows)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=[key, *names])

    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, {schema}")


_CHROME = frozenset("script style nav header footer aside form noscript button".split())
_BLOCKS = frozenset("p li dd dt blockquote td th figcaption article section div main h1 h2 h3 h4 h5 h6".split())
_HEADS = frozenset("h1 h2 h3 h4 h5 h6 dt".split())


class _Blocks(HTMLParser):
    """Leaf blocks in order, each with the heading before it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.skip = 0
        self.stack: list[str] = []
        self.text: list[str] = []
        self.tag = ""
        self.heading = ""
        self.rows: list[tuple[int, str, str, str]] = []

    def flush(self, tag: str) -> None:
        body = re.sub(r"\s+", " ", "".join(self.text)).strip()
        self.text.clear()
        if not body:
            return
        if tag in _HEADS:
            self.heading = body
        else:
            self.rows.append((len(self.rows), tag or "text", self.heading, body))

    def handle_starttag(self, tag, attrs):
        if tag in _CHROME:
            self.skip += 1
        if tag == "br":
            self.text.append(" ")
        if tag in _BLOCKS:
            self.flush(self.stack[-1] if self.stack else "")
            self.stack.append(tag)

    def handle_endtag(self, tag):
        if tag in _CHROME:
            self.skip = max(0, self.skip - 1)
        if tag in _BLOCKS and tag in self.stack:
            self.flush(tag)
            while self.stack and self.stack.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.skip:
            self.text.append(data)


def parse_blocks(html: str) -> list[tuple[int, str, str, str]]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush(parser.stack[-1] if parser.stack else "")
    return parser.rows


def blocks(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, tag, heading, body): leaf blocks of a page without its chrome; terms of definition lists are headings."""
    return _emit(df, key, html, "pos int, tag string, heading string, body string", parse_blocks)


class _Node:
    """An element with its children and texts in order."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: _Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.parts: list[_Node | str] = []

    def walk(self) -> Iterator[_Node]:
        stack: list[_Node] = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [x for x in reversed(node.parts) if isinstance(x, _Node)]

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
            else:
                stack += reversed([*x.parts, " "] if x.tag in _BLOCKS or x.tag == "br" else x.parts)
        return re.sub(r"\s+", " ", "".join(out)).strip()


_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Classes and ids of what frames a page, and of what it is about.
_FRAME = re.compile(r"breadcrumb|pankuzu|menu|sidebar|(?:^|[\s_-])g?nav(?:$|[\s_-])|global-nav", re.I)
_MAIN = re.compile(r"main|content|article", re.I)


class _Tree(HTMLParser):
    """The elements of a page; those that only frame it, by tag, class or id, are left out with all they hold."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if self.at.tag == "p" and tag in _BLOCKS or tag in ("li", "dt", "dd") and self.at.tag in (("li",) if tag == "li" else ("dt", "dd")):  # left open
            self.at = self.at.parent
        node = _Node(tag, {k: v or "" for k, v in attrs}, self.at)
        if not (tag in _CHROME or _FRAME.search(node.attrs.get("class", "")) or _FRAME.search(node.attrs.get("id", ""))):
            self.at.parts.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.at = self.at.parent or self.root

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.parts.append(data)


def tree_of(html: str) -> _Node:
    parser = _Tree()
    parser.feed(html)
    parser.close()
    return parser.root


def main_region(root: _Node) -> _Node:
    """What a page is about: <main>, else an id or a class that says so, else <article>, else the body, else all."""
    nodes = list(root.walk())
    tests = [lambda n: n.tag == "main", lambda n: _MAIN.search(n.attrs.get("id", "")), lambda n: _MAIN.search(n.attrs.get("class", "")), lambda n: n.tag == "article", lambda n: n.tag == "body"]
    return next((n for test in tests for n in nodes if test(n)), root)


_TEXTS = frozenset("p div li blockquote section dd td".split())


def parse_main_texts(html: str) -> list[tuple[int, str, str]]:
    """(pos, tag, body) of the innermost texts of the main region."""
    found = [n for n in main_region(tree_of(html)).walk() if n.tag in _TEXTS and not any(isinstance(x, _Node) and any(y.tag in _TEXTS for y in x.walk()) for x in n.parts)]
    rows = [(n.tag, body) for n in found if (body := n.text())]
    return [(k, *row) for k, row in enumerate(rows)]


_HEADINGS = frozenset(("h2", "h3", "h4"))


def following_text(node: _Node, hops: int, tags: frozenset[str]) -> str:
    """The text of the first element of `tags` among the next `hops` elements beside a node; a heading ends the search."""
    beside = [x for x in node.parent.parts if isinstance(x, _Node)]
    at = next(k for k, x in enumerate(beside) if x is node)
    for x in beside[at + 1 : at + 1 + hops]:
        if x.tag in _HEADINGS:
            return ""
        if x.tag in tags and (body := x.text()):
            return body
    return ""


def parse_answers(html: str) -> list[tuple[int, str, str, str]]:
    """(pos, how, question, answer): terms with their definitions, quotations, headings with the text that follows within three elements."""
    rows: list[tuple[str, str, str]] = []
    for n in main_region(tree_of(html)).walk():
        if n.tag == "dl":
            term = ""
            for x in n.walk():
                if x.tag == "dt":
                    term = x.text()
                elif x.tag == "dd" and (body := x.text()):
                    rows.append(("definition", term, body))
        elif n.tag == "blockquote" and (body := n.text()):
            rows.append(("quotation", "", body))
        elif n.tag in _HEADINGS and (title := n.text()) and (body := following_text(n, 3, frozenset(("p", "div", "blockquote")))):
            rows.append(("heading", title, body))
    return [(k, *row) for k, row in enumerate(rows)]


def main_texts(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, tag, body) of the innermost texts of each page's main region."""
    return _emit(df, key, html, "pos int, tag string, body string", parse_main_texts)


def answers(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, pos, how, question, answer); how is 'definition', 'quotation' or 'heading'."""
    return _emit(df, key, html, "pos int, how string, question string, answer string", parse_answers)


def headed(df: DataFrame, key: str, html: str, relevant: str, most: int = 12) -> DataFrame:
    """(key, pos, title, body): relevant headings with the text beside them; only if a page has none, its list items that are relevant; at most `most`."""
    fits = re.compile(relevant)

    def parse(page: str) -> list[tuple[int, str, str]]:
        nodes = list(main_region(tree_of(page)).walk())
        rows = [(n.text(), following_text(n, 3, frozenset(("p", "div", "ul", "table")))) for n in nodes if n.tag in _HEADINGS and fits.search(n.text())]
        rows = rows or [("", n.text()) for n in nodes if n.tag == "li" and fits.search(n.text())]
        return [(k, *row) for k, row in enumerate(rows[:most])]

    return _emit(df, key, html, "pos int, title string, body string", parse)


def parse_linked_data(html: str) -> list[tuple[str, str, str]]:
    rows: list[tuple[str, str, str]] = []

    def walk(node) -> None:
        if isinstance(node, list):
            for x in node:
                walk(x)
        elif isinstance(node, dict):
            kind = node.get("@type", "")
            kind = kind[0] if isinstance(kind, list) and kind else kind
            answer = node.get("acceptedAnswer")
            if kind == "Question" and isinstance(answer, dict) and answer.get("text"):
                rows.append(("Question", str(node.get("name") or ""), str(answer["text"])))
            else:
                body = node.get("reviewBody") or node.get("description") or node.get("text")
                author = node.get("author")
                name = node.get("name") or (author.get("name") if isinstance(author, dict) else author)
                if kind in ("Person", "Review", "Quotation") and body:
                    rows.append((kind, str(name or ""), str(body)))
            for x in node.values():
                if isinstance(x, (dict, list)) and x is not answer:
                    walk(x)

    for script in re.findall(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>", html):
        try:
            walk(json.loads(script))
        except ValueError:
            continue
    return rows


def linked_data(df: DataFrame, key: str, html: str) -> DataFrame:
    """(key, kind, name, body) of persons, reviews, quotations and questions in JSON-LD; broken scripts are passed over."""
    return _emit(df, key, html, "kind string, name string, body string", parse_linked_data)


_FIELD = re.compile(r"^[-*\s]*\**([^:：*\n]{1,20})\**\s*[:：]\s*(.+)$")


def parse_statements(text: str) -> list[tuple[str, int, str, str, str, str]]:
    """Statements of a dossier: entity headings, '### #N' blocks, key: value lines of which the first of a key wins, else the quote."""
    level = 2 if len(re.findall(r"(?m)^##\s", text)) >= 2 else 1
    heads = [(m.start(), m.end(), m.group(1).strip()) for m in re.finditer(rf"(?m)^#{{{level}}}\s+(.+)$", text)]
    spans = [(name, end, heads[k + 1][0] if k + 1 < len(heads) else len(text)) for k, (_, end, name) in enumerate(heads)] or [("", 0, len(text))]
    rows = []
    for name, a, b in spans:
        part = text[a:b]
        marks = list(re.finditer(r"(?m)^###\s+#?(\d+)?(.*)$", part))
        for k, m in enumerate(marks):
            body = part[m.end() : marks[k + 1].start() if k + 1 < len(marks) else len(part)]
            fields: dict[str, str] = {}
            for line in body.splitlines():
                f = _FIELD.match(line)
                if f:
                    fields.setdefault(f.group(1).strip().lower(), f.group(2).strip())
            quote = fields.get("quote") or " ".join(x[1:].strip() for x in body.splitlines() if x.startswith(">")).strip()
            if len(quote) >= 2:
                rows.append((name, int(m.group(1) or k + 1), fields.get("speaker", ""), fields.get("theme", m.group(2).strip()), fields.get("source", ""), quote))
    return rows


def statements(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, entity, number, speaker, theme, source, quote) of Markdown dossiers."""
    return _emit(df, key, text, "entity string, number int, speaker string, theme string, source string, quote string", parse_statements)


def parse_wiki(text: str) -> list[tuple[int, int, str, str, str]]:
    """List items of wiki text: (pos, level of the section, section, linked name, description)."""
    rows: list[tuple[int, int, str, str, str]] = []
    level, section, outer = 0, "", ""
    for line in text.splitlines():
        h = re.match(r"^(={2,5})\s*(.*?)\s*\1\s*$", line)
        if h:
            level, section = len(h.group(1)), h.group(2)
            if level == 2:
                outer = section
            continue
        item = re.match(r"^[*#]+\s*(.*)$", line)
        if item:
            body = re.sub(r"<ref[^>]*>.*?</ref>|<ref[^>]*/>|\{\{[^{}]*\}\}|'{2,}", "", item.group(1))
            link = re.search(r"\[\[([^\]|]+)(?:\|([^\]]+))?\]\]", body)
            name = (link.group(2) or link.group(1)).strip() if link else ""
            rest = re.sub(r"\[\[(?:[^\]|]*\|)?([^\]]+)\]\]", r"\1", body[link.end() :] if link else body)
            rows.append((len(rows), level, section if level == 2 or not outer else f"{outer} / {section}", name, re.sub(r"^[\s\-–—:：（(]+|[\s）)]+$", "", rest)))
    return rows


def wiki_items(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, level, section, name, description) of list items, with the section carried along."""
    return _emit(df, key, text, "pos int, level int, section string, name string, description string", parse_wiki)


#: Headings under which wiki pages list those who went to a school.
ALUMNI = "卒業生|出身者|関係者|主な人物|校友|(?:^|・)OB|(?:^|・)OG"


def alumni(df: DataFrame, key: str, text: str, headings: str = ALUMNI, excluded: str = "^(?:Category|File|ファイル|画像|カテゴリ):|一覧$|年$") -> DataFrame:
    """(key, pos, section, name, description) of the linked persons below headings that list alumni; other links are no persons."""
    items = wiki_items(df, key, text).filter(F.col("section").rlike(headings) & (F.col("name") != ""))
    return items.filter(~F.col("name").rlike(excluded)).select(key, "pos", "section", "name", "description")


def parse_events(text: str) -> list[tuple[int, str, str]]:
    """(month, event, description): events below month headings; a line in brackets describes the one before."""
    month, rows = 0, []
    for line in text.splitlines():
        line = line.strip()
        m = re.match(r"^(?:[■●・#*\s]*)?(\d{1,2})月[:：]?\s*(.*)$", line)
        if m and 1 <= int(m.group(1)) <= 12:
            month, line = int(m.group(1)), m.group(2).strip()
        if not line or not month:
            continue
        note = re.match(r"^[（(](.+)[）)]$", line)
        if note and rows:
            rows[-1] = (*rows[-1][:2], note.group(1))
            continue
        for name in re.split(r"[、,/／・]", line):
            name = re.sub(r"^[■●・*\-\s]+|^\d{1,2}日\s*", "", name).strip()
            if 2 <= len(name) <= 30:
                rows.append((month, name, ""))
    return rows


def events(df: DataFrame, key: str, text: str) -> DataFrame:
    return _emit(df, key, text, "month int, event string, description string", parse_events)


_ALIASES = {"shift_jis": "cp932", "shift-jis": "cp932", "sjis": "cp932", "x-sjis": "cp932", "windows-31j": "cp932", "euc-jp": "euc_jp", "x-euc-jp": "euc_jp", "iso-2022-jp": "iso2022_jp", "utf8": "utf-8"}


def decode_page(raw: bytes | None, named_within: int | None = None) -> str | None:
    """Text of a stored page: the charset it names, then UTF-8, then the Japanese encodings; what is left undecodable goes.

    named_within limits the bytes in which a name is looked for, for parity with tools that
    read only the first of a page.
    """
    if raw is None:
        return None
    named = re.search(rb"charset=[\"']?([A-Za-z0-9_\-]+)", raw[:named_within], re.I)
    tries = [_ALIASES.get(named.group(1).decode("ascii").lower(), named.group(1).decode("ascii").lower())] if named else []
    for codec in [*tries, "utf-8", "cp932", "euc_jp"]:
        try:
            return raw.decode(codec)
        except (UnicodeDecodeError, LookupError):
            continue
    return raw.decode("utf-8", "ignore")


def parse_values(statement: str) -> list[tuple[int, int, str | None]]:
    """(row, column, value) of the tuples of an INSERT ... VALUES statement; '' inside quotes is one quote, NULL is null."""
    at = re.search(r"(?i)\bvalues\b", statement)
    rows: list[tuple[int, int, str | None]] = []
    if not at:
        return rows
    row, depth, cell, quoted, was_quoted, col = -1, 0, "", False, False, 0
    k, s = at.end(), statement
    while k < len(s):
        c = s[k]
        if quoted:
            if c == "'" and s[k + 1 : k + 2] == "'":
                cell += "'"
                k += 1
            elif c == "'":
                quoted = False
            else:
                cell += c
        elif c == "'":
            cell = cell if was_quoted else ""
            quoted = was_quoted = True
        elif c == "(" and depth == 0:
            row, depth, cell, col, was_quoted = row + 1, 1, "", 0, False
        elif depth and c in ",)" and depth == 1:
            value = cell if was_quoted else cell.strip()
            rows.append((row, col, None if not was_quoted and value.upper() == "NULL" else value))
            col, cell, was_quoted = col + 1, "", False
            depth -= c == ")"
        elif depth:
            depth += (c == "(") - (c == ")")
            if not (was_quoted and c.isspace()):
                cell += c
        k += 1
    return rows


def inserted_values(df: DataFrame, key: str, statement: str) -> DataFrame:
    return _emit(df, key, statement, "row int, col int, value string", parse_values)
