"""SQL for the text rules, said once and used by all oracles."""

from __future__ import annotations

from termwright.functions import constants as C


def quoted(text: str) -> str:
    parts = ["'" + p.replace("'", "''") + "'" for p in text.split("\n")]
    return "(" + " || chr(10) || ".join(parts) + ")" if len(parts) > 1 else parts[0]


def blank(x: str) -> str:
    return f"trim(coalesce({x}, ''))"


def replaced(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, {quoted(a)}, {quoted(b)})"
    return x


def normalize(x: str) -> str:
    return replaced(f"translate({blank(x)}, {quoted(C.NAME_DROPPED)}, '')", C.NAME_REPLACEMENTS)


def search(x: str) -> str:
    return f"translate(regexp_replace({replaced(blank(x), C.SEARCH_REPLACEMENTS)}, '\\s+', '', 'g'), {quoted(C.SEARCH_DROPPED)}, '')"


def unit(x: str) -> str:
    return replaced(blank(x), C.UNIT_REPLACEMENTS)


def strip(x: str) -> str:
    x = blank(x)
    x = "CASE " + " ".join(f"WHEN starts_with({x}, '{p}') AND length({x}) > {len(p)} THEN substr({x}, {len(p) + 1})" for p in C.PREFIXES) + f" ELSE {x} END"
    x = "CASE " + " ".join(f"WHEN ends_with({x}, '{p}') AND length({x}) > {len(p)} THEN substr({x}, 1, length({x}) - {len(p)})" for p in C.SUFFIXES) + f" ELSE {x} END"
    return f"trim({x})"


def clean(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace(translate(coalesce({x}, ''), '　•', '  '), '[ \\t]+', ' ', 'g'), '\\n+', chr(10), 'g'))"


def lines(x: str) -> str:
    """A list of cleaned lines."""
    return f"list_filter(list_transform(string_split({clean(x)}, chr(10)), lambda l: regexp_replace(l, '^[ .。；;：:]+|[ .。；;：:]+$', '', 'g')), lambda l: l <> '')"


def family(x: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({x}, '{w}') THEN '{f}'" for w, f in C.FAMILIES) + f" ELSE '{C.OTHER_FAMILY}' END"


def string_list(x: str) -> str:
    """A list, its order the first of each value."""
    parts = f"list_filter(list_transform(regexp_split_to_array(coalesce({x}, ''), '[、,，;；/\\n]+'), lambda l: trim(l)), lambda l: l <> '')"
    return f"list_filter({parts}, lambda l, i: list_position({parts}, l) = i)"


def key(*parts: str, length: int = 16) -> str:
    return "substr(sha1(" + " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + f"), 1, {length})"
