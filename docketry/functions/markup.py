"""What a page or an XML document says: a tokenizer of markup, text by text, for columns see functions.text.

Tags are read attribute by attribute, so a ">" in quotes ends nothing; a "<" that begins no tag is text; elements whose content is raw are read to their own end tag; what is open at the end of the document ends there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.entities import html5

TEXT, START, END, CDATA = range(4)

_NAME = re.compile(r"[A-Za-z][^\s/>]*+")
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>)))?+)?+""")
#: Elements whose content has no tags.
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
#: Elements that a head may hold; any other one ends it.
OF_HEAD = frozenset(("html", "meta", "link", "base", "script", "style", "noscript", "template", "object"))
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
_SPACE = re.compile(r"\s+", re.ASCII)
_REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);")


def _tag_end(doc: str, at: int) -> int:
    """Where a tag that is open at `at` (after its name) ends; the end of the document if it doesn't."""
    while at < len(doc) and doc[at] != ">":
        step = _ATTRIBUTE.match(doc, at).end()
        at = step if step > at else at + 1
    return at


def _after(doc: str, mark: str, at: int) -> int:
    """The position behind a mark; the end of the document if it isn't there."""
    k = doc.find(mark, at)
    return len(doc) if k < 0 else k + len(mark)


def tokens(doc: str, xml: bool = False) -> Iterator[tuple[int, str]]:
    """(kind, text or name) of a document in order. Names of HTML are in small letters, an empty element of XML is a start and an end; comments, declarations and instructions are left out."""
    at = start = 0
    while (at := doc.find("<", at)) >= 0:
        after = doc[at + 1 : at + 2]
        closing = after == "/"
        name = _NAME.match(doc, at + 1 + closing)
        if not name and after not in ("!", "?") and not closing:
            at += 1
            continue
        if at > start:
            yield TEXT, doc[start:at]
        if name:
            word = name[0] if xml else name[0].lower()
            end = _tag_end(doc, name.end())
            if end == len(doc):  # a tag that doesn't end is no text either
                return
            at = start = end + 1
            yield (END if closing else START), word
            if xml and not closing and doc[end - 1] == "/":
                yield END, word.rstrip("/")
            elif not xml and not closing and word in RAW:
                close = _RAW_END[word].search(doc, at)
                at = start = close.start() if close else len(doc)
                if close and at > end + 1:
                    yield CDATA, doc[end + 1 : at]
        elif doc.startswith("<!--", at):
            at = start = at + 5 if doc.startswith("<!-->", at) else at + 6 if doc.startswith("<!--->", at) else _after(doc, "-->", at + 4)
        elif xml and doc.startswith("<![CDATA[", at):
            inside, close = at + len("<![CDATA["), doc.find("]]>", at)
            yield CDATA, doc[inside : close if close >= 0 else len(doc)]
            at = start = close + 3 if close >= 0 else len(doc)
        else:
            at = start = _after(doc, "?>" if xml and after == "?" else ">", at + 1)
    if start < len(doc):
        yield TEXT, doc[start:]


def collapsed(text: str) -> str:
    return _SPACE.sub(" ", text).strip(" ")


def unescape_whole(text: str) -> str:
    """Character references decoded that end with a semicolon; what is cut short ("&amp") stays as it is."""
    return _REFERENCE.sub(lambda m: unescape(m[0]) if m[0][1] == "#" else html5.get(m[0][1:], m[0]), text)


def html_text(page: str | None, without: frozenset[str] = frozenset(("script", "style")), bare: bool = True) -> str | None:
    """The text of the body of a page, one space between the fragments that tags part, character references decoded and white space collapsed; null for null. Elements `without` are left out with all in them, and so are
    the head and the title. A page without a body tag is all body but for its head. The few references that browsers read without their semicolon are read so too if `bare`, else only whole ones."""
    if page is None:
        return None
    decoded = unescape if bare else unescape_whole
    parts: list[str] = []
    begun = closed = head = False
    skipped: list[str] = []  # open elements of one name, from one that is left out on
    for kind, said in tokens(page):
        if kind == START:
            if skipped:
                if said == skipped[0]:
                    skipped.append(said)
            elif said in without or said == "title":
                skipped.append(said)
            elif said == "head":
                head = True
            elif said == "body":
                if not begun:  # what stands before the body is no part of it
                    parts.clear()
                begun, head, closed = True, False, False
            elif said not in OF_HEAD:
                head = False
        elif kind == END:
            if skipped:
                if said == skipped[0]:
                    skipped.pop()
            elif said == "head":
                head = False
            elif said == "body":
                closed = True
        elif not (skipped or head or closed):
            parts.append(decoded(said).replace(" ", " "))
    return collapsed(" ".join(parts))


def xml_text(doc: str | None, element: str) -> str | None:
    """The text in all elements of a name (without prefix), sections of character data as they are, references decoded elsewhere; null for null. Declarations and other files are not read."""
    if doc is None:
        return None
    parts: list[str] = []
    depth = 0
    for kind, said in tokens(doc, xml=True):
        if kind in (START, END):
            if said.rsplit(":", 1)[-1].rstrip("/") == element:
                depth = max(0, depth + (1 if kind == START else -1))
            if depth and kind == START or kind == END:
                parts.append(" ")
        elif depth:
            parts.append(said if kind == CDATA else unescape(said))
    return collapsed("".join(parts))


_BLANK, _WORD, _DIGITS = re.compile(r"\s*", re.ASCII), re.compile(r"\w+", re.ASCII), re.compile(r"[A-Za-z]?[0-9]+", re.ASCII)
#: Where a mark can begin.
_MARK = re.compile(r"\[|(?<!\w)P(?:age|g)(?!\w)", re.ASCII)


def _mark_end(text: str, at: int) -> int:
    """Where the mark of a printed record that begins at a place ends; the place itself if none begins there."""
    past = lambda i: _BLANK.match(text, i).end()
    if text[at] == "[":
        first = past(at + 1)
        if text.startswith("Time:", first):
            close = text.find("]", first + 5)
            return close + 1 if close > first + 5 else at
        word = past(at + 2)
        if text[at + 1 : at + 2] != "[" or not text.startswith("Page", word):
            return at
        name = last = past(word + 4)
        while text[last : last + 1] == "-" or (text[last : last + 1].isalnum() and text[last].isascii()):
            last += 1
        close = past(last)
        return close + 2 if name > word + 4 and last > name and text.startswith("]]", close) else at
    word = _WORD.match(text, at).end()
    number = past(word)
    said = _WORD.match(text, number)
    if number == word or not said or not _DIGITS.fullmatch(said[0]):
        return at
    upto = _WORD.match(text, said.end() + 1) if text[said.end() : said.end() + 1] == "-" else None
    return upto.end() if upto and upto[0].isdigit() else said.end()


def record_text(text: str | None) -> str | None:
    """A text without what a printed record carries besides: times and page marks in brackets, and page numbers of its foot lines; white space collapsed. Null for null.

    "[Time: ...]" goes up to the bracket that closes it, "[[Page S52]]" with both pairs, and Pg or Page with the number behind it, the hyphen of a range included; a number with other letters
    to it is none. Only where a mark can begin is anything looked at."""
    if text is None:
        return None
    kept, last = [], 0
    for mark in _MARK.finditer(text):
        if mark.start() >= last and (end := _mark_end(text, mark.start())) > mark.start():
            kept.append(text[last : mark.start()])
            last = end
    return collapsed("".join([*kept, text[last:]]))
