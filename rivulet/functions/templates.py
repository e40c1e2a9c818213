"""``${name}`` templates turned into Column expressions at plan time.

A template is split once on the driver; each ``${...}`` becomes a Column, the
text between them a literal, and the whole a ``concat``. Only attribute
substitution and the few functions the reference's flows use are supported:
``plus``, ``minus``, ``equals``, ``lt``, ``le``, ``gt``, ``ge``, ``notNull``,
``isNull``, ``isEmpty``, ``toUpper``, ``toLower``, ``trim``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Lookup = Callable[[str], Column]


def column_lookup(name: str) -> Column:
    """Wide form: an attribute is a column."""
    return F.col(f"`{name}`")


def map_lookup(map_col: str = "attributes") -> Lookup:
    """Map form: an attribute is an entry of a MAP<STRING,STRING> column."""
    return lambda name: F.element_at(F.col(map_col), F.lit(name))


def _split(template: str) -> list[tuple[str, str]]:
    """→ [("text", s) | ("expr", inner)], honouring nested ``${}``."""
    out, i, n = [], 0, len(template)
    buf = []
    while i < n:
        if template.startswith("${", i):
            depth, j = 1, i + 2
            while j < n and depth:
                if template.startswith("${", j):
                    depth, j = depth + 1, j + 2
                    continue
                if template[j] == "}":
                    depth -= 1
                j += 1
            if depth:
                raise ValueError(f"unclosed ${{ in template: {template!r}")
            if buf:
                out.append(("text", "".join(buf)))
                buf = []
            out.append(("expr", template[i + 2:j - 1]))
            i = j
        else:
            buf.append(template[i])
            i += 1
    if buf:
        out.append(("text", "".join(buf)))
    return out


def _arg(text: str, lookup: Lookup) -> Column:
    text = text.strip()
    if text.startswith("${") and text.endswith("}"):
        return expression(text[2:-1], lookup)
    if len(text) >= 2 and text[0] == text[-1] and text[0] in "'\"":
        return F.lit(text[1:-1])
    try:
        return F.lit(int(text))
    except ValueError:
        return F.lit(text)


def _num(c: Column) -> Column:
    return c.try_cast("long")


_FUNCS: dict[str, Callable[..., Column]] = {
    "plus": lambda s, a: (_num(s) + _num(a)).cast("string"),
    "minus": lambda s, a: (_num(s) - _num(a)).cast("string"),
    "equals": lambda s, a: s.cast("string") == a.cast("string"),
    "lt": lambda s, a: _num(s) < _num(a),
    "le": lambda s, a: _num(s) <= _num(a),
    "gt": lambda s, a: _num(s) > _num(a),
    "ge": lambda s, a: _num(s) >= _num(a),
    "notNull": lambda s: s.isNotNull(),
    "isNull": lambda s: s.isNull(),
    "isEmpty": lambda s: F.coalesce(F.trim(s.cast("string")) == F.lit(""), F.lit(True)),
    "toUpper": lambda s: F.upper(s),
    "toLower": lambda s: F.lower(s),
    "trim": lambda s: F.trim(s),
}


def _calls(chain: str) -> list[tuple[str, str | None]]:
    """``fn(a):g()`` → [(fn, "a"), (g, "")]; parentheses may nest."""
    calls, i, n = [], 0, len(chain)
    while i < n:
        j = chain.index("(", i)
        name = chain[i:j].strip()
        depth, k = 1, j + 1
        while depth:
            depth += {"(": 1, ")": -1}.get(chain[k], 0)
            k += 1
        calls.append((name, chain[j + 1:k - 1]))
        i = k + 1 if k < n and chain[k] == ":" else k
    return calls


def expression(inner: str, lookup: Lookup = column_lookup) -> Column:
    """The inside of one ``${...}`` → Column."""
    name, _, chain = inner.partition(":")
    col = lookup(name.strip())
    for fn, arg in _calls(chain) if chain else []:
        f = _FUNCS[fn]
        col = f(col, _arg(arg, lookup)) if arg.strip() else f(col)
    return col


def render(template: str, lookup: Lookup = column_lookup) -> Column:
    """Template → STRING Column; a missing attribute renders as ``""``."""
    parts = [F.lit(s) if kind == "text" else F.coalesce(expression(s, lookup).cast("string"), F.lit(""))
             for kind, s in _split(template)]
    if not parts:
        return F.lit("")
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def predicate(template: str, lookup: Lookup = column_lookup) -> Column:
    """A single ``${...}`` boolean expression → BOOLEAN Column."""
    parts = _split(template.strip())
    if len(parts) != 1 or parts[0][0] != "expr":
        raise ValueError(f"not a single expression: {template!r}")
    return expression(parts[0][1], lookup).cast("boolean")
