"""YAML frontmatter: splitting, parsing and rendering, as column expressions.

The flat subset connectors write (``key: scalar``, ``key: [a, b]``, ``key:`` with ``- a``
lines) is parsed by built-in functions. Blocks outside it go through one vectorised YAML
step; only those blocks are sent to Python.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from .text import trim_ws

_KEY = r"[A-Za-z_][A-Za-z0-9_-]*"
_REST = 2147483647


def closing(raw: Column) -> Column:
    """Position of the newline before the closing ``---`` line, 0 when there is no block.

    Plain string searches: bodies are long, and a pattern would walk over all of them.
    """
    opened = raw.startswith("---\n") | raw.startswith("---\r\n")
    lf = F.locate("\n---\n", raw, 4)
    # most texts have no such line; a plain test is cheaper than a position
    crlf = F.when(raw.contains("\n---\r\n"), F.locate("\n---\r\n", raw, 4)).otherwise(0)
    first = F.when(lf == 0, crlf).when(crlf == 0, lf).otherwise(F.least(lf, crlf))
    return F.when(opened, first).otherwise(0)


def has_block(raw: Column, at: Column | None = None) -> Column:
    """The text starts with a ``---`` line and has another one; ``at``: its ``closing``, where that is known."""
    return (closing(raw) if at is None else at) > 0


def block(raw: Column, at: Column | None = None) -> Column:
    """The YAML between the first two ``---`` lines, with line ends normalised."""
    text = F.substring(raw, F.lit(1), closing(raw) if at is None else at)
    return F.substring(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit(5), F.lit(_REST))


def body(raw: Column, at: Column | None = None) -> Column:
    """The text after the second ``---`` line, "" when there is no block."""
    at = closing(raw) if at is None else at
    rest = F.substring(raw, at + 1, F.lit(_REST))
    inside = F.substring(rest, F.when(rest.startswith("---\r\n"), 6).otherwise(5), F.lit(_REST))
    return F.when(at > 0, inside).otherwise("")


# Blocks of plain keys, values and items, on lines as connectors write them. A value is one or more words of printable
# ASCII, no null word, without ": " and " #", or double-quoted without escapes. Runs are possessive, and long blocks are
# no matter for the pattern, as groups that repeat are recursive.
_WORDS = r"(?!(?:null|Null|NULL)\n)[A-Za-z0-9](?:[!-9;-~]++|:(?=[!-~])| (?=[!\"$-~]))*+"
_SIMPLE = rf'\A(?:{_KEY}:(?: (?:{_WORDS}|"[ !#-\[\]-~]*+"))?\n| *+- {_WORDS}\n)*+\z'
_SIMPLE_LENGTH = 2000


def is_simple(yaml: Column) -> Column:
    """Whether a block is one that ``simple_keys``, ``simple_values`` and ``simple_list`` read: most are, others take ``yaml_lines``."""
    return F.when(F.octet_length(yaml) <= _SIMPLE_LENGTH, yaml.rlike(_SIMPLE)).otherwise(False)


def simple_keys(yaml: Column) -> Column:
    return F.regexp_extract_all(yaml, F.lit(rf"(?dm)^({_KEY}):"), 1)


def simple_values(yaml: Column) -> Column:
    """Values of ``simple_keys``, without quotes."""
    bare = F.when(yaml.contains(': "'), F.regexp_replace(yaml, rf'(?dm)^({_KEY}: )"(.*)"$', "$1$2")).otherwise(yaml)
    return F.regexp_extract_all(bare, F.lit(rf"(?dm)^{_KEY}: ?(.*)$"), 1)


def simple_list(yaml: Column, key: str) -> Column:
    """Items below the first ``key:`` of a simple block."""
    return F.regexp_extract_all(F.regexp_extract(yaml, rf"(?dm)^{key}:.*\n((?: *- .*\n)*)", 1), F.lit(r"(?dm)^ *- (.*)$"), 1)


def yaml_lines(yaml: Column) -> Column:
    """array<struct<key, value>>: key lines, list items (key ``-``), blanks and comments (key "").

    Lines of any other form have a NULL key.
    """
    def line(l: Column) -> Column:
        name = F.substring_index(l, ":", 1)
        is_key = l.rlike(rf"^{_KEY}:([ \t]|$)")
        is_item = l.rlike(r"^ *- ")
        return F.struct(
            F.when(is_key, name).when(is_item, F.lit("-")).when((F.trim(l) == "") | l.startswith("#"), F.lit("")).alias("key"),
            F.when(is_key, trim_ws(F.substring(l, F.length(name) + 2, F.lit(_REST))))
            .when(is_item, trim_ws(F.substring(l, F.locate("- ", l) + 2, F.lit(_REST)))).alias("value"))

    return F.transform(F.split(yaml, "\n"), line)


def _is_scalar(v: Column) -> Column:
    """A value the built-in parser understands: blank, plain on one line, or quoted."""
    plain = v.rlike(r"^[^\s\[\]{}&*!|>'\"%@`#,?:-]") & ~v.rlike(r":\s|:$|\s#")
    double = v.rlike(r'^"[^"\\]*(?:\\["\\nt/][^"\\]*)*"$')
    single = v.rlike(r"^'[^']*(?:''[^']*)*'$")
    return (v == "") | plain | double | single


def is_flat(lines: Column) -> Column:
    """Whether all of a block's ``yaml_lines`` are in the flat subset."""
    inline_list = r"^\[[^\[\]{}\"'#&*!|>%@`:]*\]$"
    return F.forall(lines, lambda l: F.coalesce(
        (l["key"] == "") | (((l["key"] != "-") | (l["value"] != "")) & (_is_scalar(l["value"]) | l["value"].rlike(inline_list))), F.lit(False)))


def _unquote(v: Column) -> Column:
    inner = F.substring(v, F.lit(2), F.length(v) - 2)
    mark = F.lit("\x01")
    double = F.replace(inner, F.lit("\\\\"), mark)
    for escape, char in (('\\"', '"'), ("\\n", "\n"), ("\\t", "\t"), ("\\/", "/")):
        double = F.replace(double, F.lit(escape), F.lit(char))
    double = F.replace(double, mark, F.lit("\\"))
    single = F.replace(inner, F.lit("''"), F.lit("'"))
    return (
        F.when(v.startswith('"'), double)
        .when(v.startswith("'"), single)
        .when(v.isin("~", "null", "Null", "NULL"), F.lit(""))
        .otherwise(v)
    )


def flat_fields(lines: Column) -> Column:
    """map<key, scalar text> of flat ``yaml_lines``; the first of repeated keys counts."""
    named = F.filter(lines, lambda l: ~l["key"].isin("", "-"))
    entries = F.transform(named, lambda l: F.struct(l["key"].alias("key"), _unquote(l["value"]).alias("value")))
    keys = F.transform(named, lambda l: l["key"])
    unique = F.filter(entries, lambda e, i: F.array_position(keys, e["key"]) == i + 1)
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.map_from_entries(F.when(repeated, unique).otherwise(entries))


def flat_list(lines: Column, key: str) -> Column:
    """Items of ``key: [a, b]`` or of the ``- a`` lines below ``key:``."""
    none = F.array().cast("array<string>")
    at = F.array_position(F.transform(lines, lambda l: l["key"]), key).cast("int")
    tail = F.slice(lines, at + 1, F.size(lines))
    end = F.array_position(F.transform(tail, lambda l: l["key"] == "-"), False).cast("int")
    listed = F.transform(F.when(end > 0, F.slice(tail, F.lit(1), end - 1)).otherwise(tail), lambda l: _unquote(l["value"]))
    inline = F.get(lines, at - 1)["value"]
    split = F.transform(F.split(F.btrim(inline, F.lit("[]")), ","), trim_ws)
    items = F.when(at == 0, none).when(inline.startswith("["), split).otherwise(listed)
    return F.filter(items, lambda t: t != "")


def _yaml_step():
    """The YAML step. It is built from local functions, so that workers get it by value and
    need no copy of this library."""
    def load(text: str) -> str:
        import json

        try:
            import yaml

            loaded = yaml.load(text, Loader=yaml.BaseLoader)
        except ImportError:
            return json.dumps({"!": "YAML outside the flat subset"})
        except yaml.YAMLError as error:
            return json.dumps({"!": str(error).split("\n")[0]})
        if loaded is None or loaded == "":
            return "{}"
        if not isinstance(loaded, dict):
            return json.dumps({"!": "frontmatter is not a mapping"})
        return json.dumps({str(k): v for k, v in loaded.items()}, ensure_ascii=False)

    @F.pandas_udf(T.StringType())
    def yaml_to_json(blocks: pd.Series) -> pd.Series:
        return blocks.map(load, na_action="ignore")

    return yaml_to_json


# One YAML mapping as JSON text of strings and lists, {"!": message} when it is not one;
# vectorised, NULL in and NULL out.
yaml_to_json = _yaml_step()


def render_scalar(v: Column) -> Column:
    """YAML scalar: plain where that is unambiguous, double-quoted otherwise."""
    escaped = F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    escaped = F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t"))
    quoted = F.concat(F.lit('"'), escaped, F.lit('"'))
    plain = (
        v.rlike(r"^[^\s\[\]{}&*!|>'\"%@`#,?:-]")
        & ~v.rlike(r":\s|:$|\s#|[\n\t\x01]|\s$")
        & ~v.rlike(r"(?i)^(true|false|yes|no|on|off|y|n|null|~|[-+.]?\d[\d_.,eE:+TZ -]*|\.(inf|nan))$")
    )
    return F.when(plain, v).otherwise(quoted)


def render(fields: dict[str, Column]) -> Column:
    """Frontmatter block with its ``---`` lines; empty fields are left out."""
    parts = []
    for name in fv.FRONTMATTER_FIELDS:
        if name not in fields:
            continue
        value = fields[name]
        if name == "tags":
            items = F.array_join(F.transform(value, lambda t: F.concat(F.lit("    - "), render_scalar(t), F.lit("\n"))), "")
            line = F.when(F.size(value) > 0, F.concat(F.lit("tags:\n"), items))
        else:
            line = F.when(value != "", F.concat(F.lit(f"{name}: "), render_scalar(value), F.lit("\n")))
        parts.append(F.coalesce(line, F.lit("")))
    if "extra" in fields:
        pairs = F.array_sort(F.map_entries(F.coalesce(fields["extra"], F.create_map().cast("map<string,string>"))))
        parts.append(F.array_join(
            F.transform(pairs, lambda e: F.concat(e["key"], F.lit(": "), render_scalar(e["value"]), F.lit("\n"))), ""))
    return F.concat(F.lit("---\n"), *parts, F.lit("---\n"))
