"""Licence scan: Aho-Corasick over words, shunting-yard over expressions."""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buildmend.llm.common import by_batch

#: Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Licence names of the method, the family that each stands for, and its versions.
FAMILIES = {
    "apache license": ("Apache", ["1.0", "1.1", "2.0"]),
    "mozilla public license": ("MPL", ["1.0", "1.1", "2.0"]),
    "eclipse public license": ("EPL", ["1.0", "2.0"]),
    "gnu general public license": ("GPL", ["1.0", "2.0", "3.0"]),
    "gnu lesser general public license": ("LGPL", ["2.1", "3.0"]),
    "gnu library general public license": ("LGPL", ["2.0"]),
    "gnu affero general public license": ("AGPL", ["3.0"]),
    "gnu free documentation license": ("GFDL", ["1.1", "1.2", "1.3"]),
    "european union public licence": ("EUPL", ["1.1", "1.2"]),
    "common development and distribution license": ("CDDL", ["1.0", "1.1"]),
    "artistic license": ("Artistic", ["1.0", "2.0"]),
    "academic free license": ("AFL", ["2.1", "3.0"]),
    "open software license": ("OSL", ["2.1", "3.0"]),
    "boost software license": ("BSL", ["1.0"]),
    "sil open font license": ("OFL", ["1.0", "1.1"]),
    "creative commons attribution": ("CC-BY", ["2.0", "2.5", "3.0", "4.0"]),
    "creative commons attribution sharealike": ("CC-BY-SA", ["2.0", "2.5", "3.0", "4.0"]),
    "creative commons attribution share alike": ("CC-BY-SA", ["2.0", "2.5", "3.0", "4.0"]),
    "creative commons attribution noncommercial": ("CC-BY-NC", ["2.0", "2.5", "3.0", "4.0"]),
    "creative commons attribution noncommercial sharealike": ("CC-BY-NC-SA", ["2.0", "2.5", "3.0", "4.0"]),
    "creative commons attribution noncommercial noderivatives": ("CC-BY-NC-ND", ["2.0", "2.5", "3.0", "4.0"]),
    "creative commons attribution noderivatives": ("CC-BY-ND", ["2.0", "2.5", "3.0", "4.0"]),
}
#: Families whose identifiers say whether later versions are allowed.
LATER = ["GPL", "LGPL", "AGPL", "GFDL"]
ANY_LATER = ["or later", "or any later version", "or at your option any later version", "of the license or at your option any later version"]
PUBLISHED = "as published by the free software foundation"

#: Other notice phrases and what they stand for.
PHRASES = {
    "mit license": "MIT",
    "permission is hereby granted free of charge": "MIT",
    "bsd license": "BSD",
    "bsd 2 clause": "BSD-2-Clause",
    "bsd 3 clause": "BSD-3-Clause",
    "redistribution and use in source and binary forms": "BSD",
    "neither the name of the copyright holder nor the names of its contributors": "BSD-3-Clause",
    "isc license": "ISC",
    "zlib license": "Zlib",
    "the unlicense": "Unlicense",
    "microsoft public license": "MS-PL",
    "public domain": "public-domain",
    "cc0 1 0": "CC0-1.0",
}


def notices() -> dict[str, str]:
    """All notice phrases. A name alone stands for its family; a version is claimed only where it is written."""
    out = dict(PHRASES)
    for name, (family, numbers) in FAMILIES.items():
        out[name] = family
        for number in numbers:
            written = {number.replace(".", " "), number.removesuffix(".0").replace(".", " ")}
            forms = {f"{name} {lead}{w}" for w in written for lead in ("", "v", "version ")}
            only, later = ("-only", "-or-later") if family in LATER else ("", "")
            if later:
                forms |= {f"{name} {PUBLISHED} {lead}version {w}" for w in written for lead in ("", "either ")}
                out |= {f"{form} {tail}": f"{family}-{number}{later}" for form in forms for tail in ANY_LATER}
            out |= {form: f"{family}-{number}{only}" for form in forms}
    return out


NOTICES = notices()

#: How much a licence asks of a user, from nothing (0) to everything (1).
DEMANDS = {
    "cc0": 0.0, "public-domain": 0.0, "unlicense": 0.0, "0bsd": 0.0, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "zlib": 0.1, "bsl": 0.1,
    "apache": 0.15, "cc-by": 0.2, "afl": 0.2, "ofl": 0.3, "artistic": 0.3, "ms-pl": 0.4, "mpl": 0.4, "cddl": 0.45, "epl": 0.45,
    "lgpl": 0.5, "cc-by-sa": 0.6, "gfdl": 0.6, "eupl": 0.6, "osl": 0.7, "gpl": 0.8, "cc-by-nd": 0.8, "cc-by-nc": 0.8,
    "cc-by-nc-sa": 0.85, "agpl": 0.9, "cc-by-nc-nd": 0.9, "reserved": 1.0,
}
UNKNOWN = 0.7
#: An exception takes off this share of what its licence asks.
RELIEF = 0.25

TAG = "spdx-license-identifier:"
TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
STRENGTH = {"or": 1, "and": 2, "with": 3}
#: Everything that separates words, as spaces; upper case as lower case.
FLAT = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def demand(label: str) -> float:
    """Demand of an identifier: its own entry, else that of its longest beginning that has one."""
    name = label.lower().rstrip("+")
    while name:
        if name in DEMANDS:
            return DEMANDS[name]
        name = name.rpartition("-")[0]
    return UNKNOWN


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: an expression in postfix order, or None if malformed."""
    out, held, operand = [], [], True
    for token in tokens:
        low = token.lower()
        if token == "(":
            if not operand:
                return None
            held.append(token)
        elif token == ")":
            if operand:
                return None
            while held and held[-1] != "(":
                out.append(held.pop())
            if not held:
                return None
            held.pop()
        elif low in STRENGTH:
            if operand:
                return None
            while held and held[-1] != "(" and STRENGTH[held[-1]] >= STRENGTH[low]:
                out.append(held.pop())
            held.append(low)
            operand = True
        else:
            if not operand:
                return None
            out.append(token)
            operand = False
    if operand or "(" in held:
        return None
    return out + held[::-1]


def evaluate(order: list[str]) -> tuple[float, set[str]] | None:
    """Demand and labels of a postfix expression: or chooses the least, and the most."""
    stack: list[tuple[float, set[str]]] = []
    for token in order:
        if token in STRENGTH:
            (y, right), (x, left) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((x * (1 - RELIEF), left | right))
            else:
                stack.append(((min if token == "or" else max)(x, y), left | right))
        else:
            stack.append((demand(token), {token.lower()}))
    return stack[0] if len(stack) == 1 else None


def expressions(text: str) -> list[tuple[float, set[str]]]:
    """Every tagged expression, each up to the end of its line.

    It goes on over the next line while a bracket is open or an operator waits
    for its right side, and never beyond the next tag. Reads the longest
    well-formed beginning: a line may go on in prose.
    """
    low, found = text.lower() if text.isascii() else re.sub("[A-Z]+", lambda m: m[0].lower(), text), []
    after = low.find(TAG)
    while after >= 0:
        at = after + len(TAG)
        after = low.find(TAG, at)
        line_end = low.find("\n", at)
        tokens, last, depth = [], None, 0
        for m in TOKEN.finditer(text, at, len(text) if after < 0 else after):
            waits = depth > 0 or (tokens and tokens[-1].lower() in STRENGTH)
            if 0 <= line_end < m.start():
                if not waits:
                    break
                line_end = low.find("\n", m.start())
            operator = m[0].lower() in STRENGTH
            if tokens and not operator and m[0] not in "()" and (tokens[-1] not in "(" and tokens[-1].lower() not in STRENGTH):
                break
            tokens.append(m[0].rstrip(".:") if m[0] not in "()" else m[0])
            depth += (m[0] == "(") - (m[0] == ")")
            if depth == 0 and not operator:
                last = len(tokens)
        order = postfix(tokens[:last]) if last else None
        value = evaluate(order) if order else None
        if value:
            found.append(value)
    return found


def longest(hits: list[tuple[int, int, str]]) -> set[str]:
    """Phrases that stand somewhere in no longer one; ``hits`` are (start, -end, phrase)."""
    out, reached = set(), 0
    for start, end, phrase in sorted(hits):
        if -end > reached:
            out.add(phrase)
            reached = -end
    return out


def automaton() -> ahocorasick.Automaton:
    trie = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES}:
        trie.add_word(f" {phrase} ", phrase)
    trie.make_automaton()
    return trie


def scan(text: str, trie: ahocorasick.Automaton) -> tuple[int, int, int | None, int | None, str, str, float]:
    words = text.encode("utf-8", "surrogatepass").translate(FLAT).split()
    line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    n_base, first, last, base, own, score = 0, None, None, set(), set(), 0.0
    word, seen, hits = 0, 0, []
    for end, phrase in trie.iter(line):
        start = end - len(phrase) - 1
        if phrase in BASE:
            word += line.count(" ", seen, start) if start >= seen else -line.count(" ", start, seen)
            seen = start
            n_base += 1
            first, last = word if first is None else min(first, word), word if last is None else max(last, word)
            base.add(BASE[phrase])
            score = max(score, demand(BASE[phrase]))
        if phrase in NOTICES:
            hits.append((start, -end, phrase))
    for phrase in longest(hits):
        own.add(NOTICES[phrase].lower())
        score = max(score, demand(NOTICES[phrase]))
    if "dentifier:" in text or "DENTIFIER:" in text.upper():
        for value, labels in expressions(text):
            own |= labels
            score = max(score, value)
    return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(base | own)), score


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Licence phrases, labels and demands of whole texts.

    Null and empty texts have no words, no labels and score 0. Several notices
    of one text all hold, so the most demanding decides; within an expression
    ``or`` takes the least and ``and`` the most demanding side and an exception
    relieves. Of notices within each other the longest holds, and one without a
    version claims none. Malformed expressions are passed over. Very long texts
    are read whole, in time linear in their length. Repeated rows give a row
    each, an empty table none; extra columns are not read.

    Returns: ``<doc_id>``, n_words, n_base, first_word, last_word, base_labels, labels, score.
    """

    def make():
        trie = automaton()

        def batch(rows: dict[str, list]) -> dict[str, list]:
            found = [scan(t or "", trie) for t in rows["body"]]
            return {"id": rows["id"]} | {c: [f[i] for f in found] for i, c in enumerate(COLUMNS)}

        return batch

    given = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    id_type = given.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return by_batch(given, make, schema).withColumnRenamed("id", doc_id)
