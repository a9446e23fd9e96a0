"""Printed rosters of committees: where the columns of a page part, and what its running text says."""

from __future__ import annotations

import re

# The roles that a roster prints and their names, what may follow a name, and small words inside of one.
ROLES = {"chair": "Chairman", "chairman": "Chairman", "vice chair": "Vice Chairman", "vice chairman": "Vice Chairman", "ranking": "Ranking Member", "ranking member": "Ranking Member", "ranking minority member": "Ranking Member"}
ROLE_WORDS = {"chair", "chairman", "vice", "ranking", "member", "minority", "cochair", "co-chair"}
SUFFIXES = {"jr", "sr", "ii", "iii", "iv"}
PARTICLES = {"de", "del", "della", "der", "den", "di", "da", "dos", "du", "la", "van", "von"}

_GAPS = re.compile(r"(?<=\S)\s{2,}(?=\S)")
_QUOTED = re.compile(r"``.*?''|\"[^\"]*\"|“[^”]*”")


def heading_key(line: str) -> str:
    """The words of a committee's name, without the word committee."""
    return " ".join(w for w in re.findall(r"[a-z0-9]+", line.lower()) if w not in ("committee", "committees"))


def gutter(lines: list[str]) -> int | None:
    """The character column where the two columns of a block part: the one that is blank between two cells in most lines, the first of such; None if all lines are one cell."""
    blank: dict[int, int] = {}
    for line in lines:
        for gap in _GAPS.finditer(line):
            for k in range(gap.start(), gap.end()):
                blank[k] = blank.get(k, 0) + 1
    return min(blank, key=lambda k: (-blank[k], k)) if blank else None


def columns(lines: list[str]) -> tuple[list[str], list[str]]:
    """The cells of the left and of the right column, downwards. A line is cut at the gap over the gutter, or at its widest one if it has none there; a line without gaps that begins beyond the gutter
    has a blank left cell."""
    at = gutter(lines)
    left, right = [], []
    for line in lines:
        gaps = [g.span() for g in _GAPS.finditer(line)]
        if gaps and at is not None:
            start, end = max(gaps, key=lambda g: (g[0] <= at < g[1], g[1] - g[0]))
            left.append(line[:start])
            right.append(line[end:])
        else:
            inset = len(line) - len(line.lstrip())
            (right if at is not None and inset > at else left).append(line)
    return left, right


class Phrases:
    """A trie of phrases by their words; the longest one that begins at a word is found."""

    def __init__(self, named: dict[str, str]):
        self.root: dict = {}
        for phrase, name in named.items():
            node = self.root
            for w in phrase.lower().replace(".", "").split():
                node = node.setdefault(w, {})
            if node is not self.root:
                node[None] = name

    def at(self, words: list[str], k: int) -> tuple[str, int] | None:
        """(name, where it ends) of the longest phrase from word k on."""
        node, found = self.root, None
        while k < len(words):
            node = node.get(words[k].lower().replace(".", "").rstrip(",;:'’"))
            if node is None:
                break
            k += 1
            if None in node:
                found = node[None], k
            if words[k - 1][-1] in ",;:":  # a phrase doesn't go on after a comma
                break
        return found


def entries(cells: list[str], states: Phrases, roles: Phrases) -> list[tuple[str, str, str, str | None]]:
    """(first name, last name, state, role) of the people in the running text of some cells: a name, ", of", a state and maybe a role; full stops between entries may be missing.

    Words of a name are gathered until something else stands between: a word in small letters that no name holds, a number, an address, a role, a comma that no suffix follows, a cell
    that is the name of a state, or the end of a sentence."""
    parts = [_QUOTED.sub(" ", c).split() for c in cells]
    words, name, out, k, ends = [w for p in parts for w in p], [], [], 0, {}
    for p in parts:
        ends[k], k = k + len(p), k + len(p)
    k = 0
    while k < len(words):
        word = words[k]
        alone = states.at(words, k) if k in ends else None
        if alone and alone[1] == ends[k]:
            name, k = [], ends[k]
            continue
        bare = word.rstrip(".,;:").lower()
        if bare == "of" and k and words[k - 1].endswith(","):
            place = states.at(words, k + 1)
            whole = [w.rstrip(",") for w in name]
            while whole and whole[-1].rstrip(".").lower() in SUFFIXES:
                whole.pop()
            name = []
            if place:
                state, k = place
                role = None if words[k - 1].endswith(".") else roles.at(words, k)
                if len(whole) > 1:
                    out.append((whole[0], whole[-1], state, role[0] if role else None))
                k = role[1] if role else k
                continue
        elif bare in PARTICLES and name:
            name.append(word)
        elif word[0].isupper() and "/" not in word and bare not in ROLE_WORDS:
            if name and name[-1].endswith(",") and bare not in SUFFIXES:
                name = []
            name.append(word)
            if word.endswith(".") and len(bare) > 4:
                name = []
        else:
            name = []
        k += 1
    return out


def assignments(page: str | None, committees: set[str], states: Phrases, roles: Phrases) -> list[tuple[str, bool, str, str, str, str | None]]:
    """(committee, is a subcommittee, first name, last name, state, role) of a page. A line that is the name of a committee (by its key), or begins with "Subcommittee on", heads what follows;
    lines all in capitals are titles of the page and belong to no block."""
    blocks: list[tuple[str, bool, list[str]]] = []
    for line in (page or "").expandtabs().splitlines():
        said = line.strip()
        sub = said.lower().startswith("subcommittee on")
        if sub or (said and heading_key(said) in committees and heading_key(said)):
            blocks.append((said, sub, []))
        elif said and blocks and said != said.upper():
            blocks[-1][2].append(line.rstrip())
    return [(name, sub, *e) for name, sub, lines in blocks for cells in columns(lines) for e in entries(cells, states, roles)]
