"""SQL text for reading loosely structured JSON held as VARIANT.

External trace exports name the same value in several ways.  These helpers
build `coalesce` chains over alias paths; everything stays in JVM expressions.
A JSON null counts as absent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lampyris.operators.quality import ERRORS, REJECTED, STATUS, with_source_evidence

UNPARSABLE = "validity:unparsable_document"


def settled(frame: DataFrame) -> DataFrame:
    """Keep filters above from being pushed into long column expressions.

    Catalyst substitutes a filter's columns by their definitions when it moves
    the filter down; through several layers of derived columns that multiplies
    the work.  A one-row generator ends the substitution.
    """
    names = ", ".join(f"'{c}', `{c}`" for c in frame.columns)
    return frame.selectExpr(f"inline(array(named_struct({names})))")


def parsed(lines: DataFrame, column: str, name: str) -> DataFrame:
    """JSON text as a VARIANT column, parsed once per row; for the other rows see ``unparsable``."""
    return settled(lines.selectExpr(f"try_parse_json({column}) as {name}")).where(f"{name} is not null")


def unparsable(lines: DataFrame, column: str, system: str, entity: str) -> DataFrame:
    """Rejects for rows that are no JSON document (broken text, a key given twice, a document too large)."""
    broken = lines.where(f"try_parse_json({column}) is null")
    labelled = broken.select(F.array(F.lit(UNPARSABLE)).alias(ERRORS), F.lit(REJECTED).alias(STATUS), F.sha2(column, 256).alias("_hash"))
    nothing = F.lit(None).cast("string")
    return with_source_evidence(labelled, system, entity, nothing, nothing, F.col("_hash")).drop("_hash")


def at(root: str, path: str) -> str:
    return f"try_variant_get({root}, '$.{path}', 'variant')"


def present(variant: str) -> str:
    """The value, or SQL NULL for a JSON null."""
    return f"if(is_variant_null({variant}), null, {variant})"


def first_of(root: str, *paths: str) -> str:
    """First path that holds a value, as text (canonical JSON for objects)."""
    return one_of(*[f"try_variant_get({root}, '$.{p}', 'string')" for p in paths])


def variant_of(root: str, *paths: str) -> str:
    """First path that holds a value, still as VARIANT."""
    return one_of(*[present(at(root, p)) for p in paths])


def one_of(*values: str) -> str:
    return values[0] if len(values) == 1 else f"coalesce({', '.join(values)})"


def structure(**paths: Sequence[str]) -> str:
    """Type of one structure that holds a document's values at dotted paths, given by the type of their values."""
    tree: dict = {}
    for kind, names in paths.items():
        for name in names:
            *above, last = name.split(".")
            node = tree
            for part in above:
                node = node.setdefault(part, {})
            node[last] = kind

    def written(node: dict) -> str:
        fields = (f"`{name}`: {kind if isinstance(kind, str) else written(kind)}" for name, kind in node.items())
        return f"struct<{', '.join(fields)}>"

    return written(tree)


def taken(root: str, kind: str) -> str:
    """All values that a ``structure`` names, read in one pass; what is absent or of another kind is NULL.

    Reading path by path walks the document once for each name a value may have, which costs most where few of the names are there.
    """
    return f"try_variant_get({root}, '$', '{kind}')"


def first_taken(root: str, *paths: str) -> str:
    """``first_of`` over values that were ``taken`` as text."""
    return one_of(*[f"{root}.{p}" for p in paths])


def json_taken(root: str, *paths: str) -> str:
    """JSON text of the first value among those ``taken`` as VARIANT."""
    return f"to_json({one_of(*[present(f'{root}.{p}') for p in paths])})"


def layered_taken(layers: Sequence[str], *keys: str) -> str:
    """``layered`` over objects ``taken`` key by key as VARIANT, topmost first: a JSON null hides the value below it."""
    return one_of(*[f"cast(coalesce({', '.join(f'{layer}.{k}' for layer in layers)}) as string)" for k in keys])


def text_map(root: str, path: str) -> str:
    """The JSON object at the path as map<string,string>; empty for anything else."""
    return f"coalesce(try_variant_get({root}, '$.{path}', 'map<string,string>'), cast(map() as map<string,string>))"


def overlay(upper: str, lower: str) -> str:
    """Merged maps.  A key the upper map names with null hides the lower one's value.

    Pass column or field names: each map is mentioned several times.
    """
    rest = f"map_filter({lower}, (k, v) -> not map_contains_key({upper}, k))"
    return f"case when size({lower}) = 0 then {upper} when size({upper}) = 0 then {lower} else map_concat({upper}, {rest}) end"


def layered(merged: str, *keys: str) -> str:
    """First of the keys that has a value in a merged map."""
    return one_of(*[f"try_element_at({merged}, '{k}')" for k in keys])


def layered_variant(layers: Sequence[str], *keys: str) -> str:
    """Like ``layered`` over VARIANT objects, topmost first, for lists and objects."""
    return one_of(*[present(one_of(*[at(layer, k) for layer in layers])) for k in keys])


def text(variant: str, default: str | None = "") -> str:
    """Strings as they are, other values as canonical JSON text (sorted keys)."""
    value = f"cast({variant} as string)"
    return value if default is None else f"coalesce({value}, '{default}')"


def integer(value: str, default: int | str | None = None) -> str:
    """Whole number from text whose kind is not known any more (merged metadata); a fraction is cut off."""
    whole = f"try_cast(try_cast({value} as decimal(38,6)) as bigint)"
    return whole if default is None else f"coalesce({whole}, {default})"


def integer_of(root: str, *paths: str) -> str:
    """Whole number at the first path that holds a value.

    A fractional number is cut off; text has to be a whole number, else the
    value counts as not understood (NULL).
    """
    return integer_in(one_of(*[f"nullif(to_json({at(root, p)}), 'null')" for p in paths]))


def integer_in(held: str) -> str:
    """``integer_of`` for JSON text."""
    number = f"regexp_extract({held}, '^(\"\\\\s*[+-]?[0-9]+\\\\s*\"|[+-]?[0-9.]+([eE][+-]?[0-9]+)?)$', 1)"
    return f"try_cast(try_cast(trim(replace({number}, '\"', '')) as decimal(38,6)) as bigint)"


def real(variant: str, default: float | None = None) -> str:
    value = f"try_cast({variant} as double)"
    return value if default is None else f"coalesce({value}, {default}D)"


def truth(variant: str) -> str:
    return f"coalesce(lower(cast({variant} as string)) in ('1', 'true', 'yes', 'y'), false)"


def is_set(variant: str) -> str:
    """Whether a value is there and not empty, zero or false."""
    return f"coalesce(cast({variant} as string), '') not in ('', '0', '0.0', 'false', '[]', '{{}}')"


def instant(variant: str) -> str:
    """ISO-8601 text as a timestamp; text without an offset is UTC."""
    dated = f"regexp_extract(cast({variant} as string), '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([T ].*)?)$', 1)"
    return f"try_cast({dated} as timestamp)"


def elapsed_ms(start: str, end: str) -> str:
    """Whole milliseconds between two timestamps, cut off like a float product."""
    return f"cast((unix_micros({end}) - unix_micros({start})) / 1000000D * 1000D as bigint)"


def objects(array_sql: str) -> str:
    """Only the elements that are JSON objects."""
    return f"filter({array_sql}, x -> {is_object('x')})"


def is_object(variant: str) -> str:
    """Whether it is a JSON object; a structure without fields copies none of it."""
    return f"try_variant_get({variant}, '$', 'struct<>') is not null"


def variants(variant: str) -> str:
    """A JSON list as array<variant>; NULL for anything else."""
    return f"try_variant_get({variant}, '$', 'array<variant>')"


def first_list(*held: tuple[str, str]) -> str:
    """The first (root, path) that holds a value, as array<variant>; NULL if that is no list. A list is copied once."""
    if not held:
        return "cast(null as array<variant>)"
    (root, path), *rest = held
    taken = f"{present(at(root, path))} is not null"
    return f"coalesce(try_variant_get({root}, '$.{path}', 'array<variant>'), if({taken}, null, {first_list(*rest)}))"


def signal(value: str) -> str:
    """Text as a comparable tag: trimmed, lower case, underscores for blanks."""
    return f"replace(lower(trim({value})), ' ', '_')"


def sha(value: str) -> str:
    return f"if({value} <> '', sha2({value}, 256), '')"


def json_list(strings: str) -> str:
    """array<string> as JSON text with a blank after each comma."""
    quoted = f"transform({strings}, s -> substring(to_json(array(s)), 2, length(to_json(array(s))) - 2))"
    return f"concat('[', array_join({quoted}, ', '), ']')"


def spaced_json(compact: str) -> str:
    """Compact JSON text with a blank after separators outside strings."""
    pattern = r"\\G((?:[^\",:]++|\"(?:[^\"\\\\]++|\\\\.)*+\")*+)([,:])"
    return f"regexp_replace({compact}, '{pattern}', '$1$2 ')"


def columns(**exprs: str) -> list[str]:
    return [f"{sql} as `{name}`" for name, sql in exprs.items()]
