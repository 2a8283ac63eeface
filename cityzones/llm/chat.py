"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

A record is a struct, variant or JSON text of unknown layout.  Its nested field
paths, restricted to the paths that any mapping mentions, are hashed; the hash
selects the mapping that names exactly these paths.  A mapping declares where
the turns come from, and every layout ends as rows (id, turn, role, text).

``render`` turns these rows into one string per conversation and a loss mask.
Control characters inside roles and texts are escaped with a backslash, so the
markers cannot occur in them and ``parse`` restores the turns exactly.
"""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Markers around a turn: ``open`` role ``middle`` text ``close``.

    Each marker must hold a ``#`` or ``<``, which the escape keeps out of roles and texts."""

    open: str = "### "
    middle: str = " ###\n"
    close: str = " </turn>\n"


TEMPLATE = Template()
CONTROL = r"[\\#<]"
ESCAPED = r"\\([\\#<])"


@dataclass(frozen=True)
class Mapping:
    """One layout.  ``turns`` is a list of (role, path) read in order, a literal role for a text field;
    or ``items`` names an array of turns whose elements hold ``role`` and ``text``; or, with neither, the record
    itself is one turn with ``order``, ``role`` and ``text``.  ``roles`` renames roles."""

    name: str
    turns: tuple[tuple[str, str], ...] = ()
    items: str | None = None
    order: str | None = None
    role: str | None = None
    text: str | None = None
    roles: dict[str, str] = field(default_factory=dict)

    def paths(self) -> list[str]:
        """Every nested field path that the layout is made of, sorted."""
        if self.turns:
            return sorted(p for _, p in self.turns)
        if self.items:
            return sorted([self.items, f"{self.items}[].{self.role}", f"{self.items}[].{self.text}"])
        return sorted(p for p in (self.order, self.role, self.text) if p)

    def fingerprints(self) -> list[str]:
        """Hashes of the path sets this mapping reads: lists may be empty or lack a field in all their elements."""
        whole = self.paths()
        optional = [p for p in whole if "[]" in p]
        return [hashlib.sha256("\n".join(p for p in whole if p not in gone).encode()).hexdigest()
                for n in range(len(optional) + 1) for gone in itertools.combinations(optional, n)]


MAPPINGS = (
    Mapping("turn_rows", order="turn", role="role", text="text"),
    Mapping("messages", items="messages", role="role", text="content"),
    Mapping("conversations", items="conversations", role="from", text="value",
            roles={"human": "user", "gpt": "assistant"}),
    Mapping("prompt_response", turns=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt_completion", turns=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("instruction", turns=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction_input", turns=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("system_prompt_response", turns=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
)


def _present(record: Column, path: str) -> Column:
    """Does the record have the field, or one of its list's elements (``list[].field``)?  A null value counts."""
    items, _, field = path.partition("[].")
    if not field:
        return F.try_variant_get(record, f"$.{path}", "variant").isNotNull()
    return F.exists(F.try_variant_get(record, f"$.{items}", "array<variant>"),
                    lambda x: F.try_variant_get(x, f"$.{field}", "variant").isNotNull())


def _known_paths(mappings) -> list[str]:
    return sorted({p for m in mappings for p in m.paths()})


def record_fingerprint(record: Column, mappings=MAPPINGS) -> Column:
    """Hash of the known nested field paths present in a variant record, the union over all elements of a list.

    Paths of no mapping are ignored, so extra fields don't change the layout.  A field that holds null is present."""
    present = [F.when(_present(record, p), F.lit(p)) for p in _known_paths(mappings)]
    return F.sha2(F.concat_ws("\n", *present), 256)


def canonical_turns(df: DataFrame, id_col: str, record: str, mappings=MAPPINGS) -> DataFrame:
    """Rows (id, turn, role, text, layout) from a column of heterogeneous records.

    ``record`` is JSON text, a struct or a variant.  A null, malformed or unknown record gives one row with null
    turn, role, text and layout, so nothing disappears unnoticed.  An element that lacks a field has a null there; an empty
    list gives one row with its layout and null turn, role and text.  In "turn_rows" the record is a turn."""
    kind = df.schema[record].dataType.typeName()
    r = F.col(record)
    variant = r if kind == "variant" else F.try_parse_json(r) if kind == "string" else F.to_variant_object(r)
    found = df.select(F.col(id_col).alias("id"), variant.alias("_v"))
    found = found.withColumn("_f", F.when(F.col("_v").isNotNull(), record_fingerprint(F.col("_v"), mappings)))
    v = F.col("_v")

    def get(path: str, kind: str = "string") -> Column:
        return F.try_variant_get(v, f"$.{path}", kind)

    def renamed(role: Column, names: dict[str, str]) -> Column:
        for old, new in names.items():
            role = F.when(role == old, F.lit(new)).otherwise(role)
        return role

    def turn(at: Column, role: Column, text: Column) -> Column:
        return F.struct(at.cast("long").alias("turn"), role.cast("string").alias("role"), text.alias("text"))

    def element(m: Mapping):
        return lambda x, i: turn(i, renamed(F.try_variant_get(x, f"$.{m.role}", "string"), m.roles),
                                 F.try_variant_get(x, f"$.{m.text}", "string"))

    layout, turns = F.lit(None).cast("string"), F.array(turn(F.lit(None), F.lit(None), F.lit(None).cast("string")))
    for m in mappings:
        if m.turns:
            made = F.array(*[turn(F.lit(i), F.lit(role), get(p)) for i, (role, p) in enumerate(m.turns)])
        elif m.items:
            made = F.transform(get(m.items, "array<variant>"), element(m))
        else:
            made = F.array(turn(get(m.order, "long") if m.order else F.lit(0), renamed(get(m.role), m.roles),
                                get(m.text)))
        mine = F.col("_f").isin(m.fingerprints())
        layout, turns = F.when(mine, F.lit(m.name)).otherwise(layout), F.when(mine, made).otherwise(turns)
    return (found.select("id", layout.alias("layout"), F.explode_outer(turns).alias("_t"))
            .select("id", "_t.turn", "_t.role", "_t.text", "layout"))


def escape(text: Column) -> Column:
    """Backslash before every control character.  Null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1")


def render(turns: DataFrame, template: Template = TEMPLATE, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per id: ``formatted`` string, ``n_turns`` and ``mask``, the spans to learn from.

    Turns are ordered by (turn, role, text), nulls first, so ties have one order; repeated rows stay repeated turns.
    A span is (turn position, start, offset, length) in code points: ``start`` counts from the beginning of the
    formatted string, ``offset`` from the beginning of its turn."""
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    w = Window.partitionBy("id").orderBy(*order)
    t = turns.select("id", "turn", "role", "text", escape(F.col("role")).alias("_r"), escape(F.col("text")).alias("_t"))
    head = F.concat(F.lit(template.open), F.col("_r"), F.lit(template.middle))
    t = t.select("id", (F.row_number().over(w) - 1).alias("position"),
                 F.concat(head, F.col("_t"), F.lit(template.close)).alias("piece"),
                 F.col("role").isin(*learn).alias("learn"), F.length(head).alias("offset"),
                 F.length("_t").alias("length"), "turn", "role", "text")
    end = F.sum(F.length("piece")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    t = t.select("id", "position", "piece", "learn", "offset", "length",
                 (end - F.length("piece") + F.col("offset")).alias("start"))
    g = t.groupBy("id").agg(F.array_sort(F.collect_list(
        F.struct("position", "piece", "learn", "start", "offset", "length"))).alias("p"))
    return g.select("id", F.size("p").cast("long").alias("n_turns"),
                    F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"),
                    F.transform(F.filter("p", lambda x: x["learn"]), lambda x: F.struct(
                        x["position"].alias("position"), x["start"].alias("start"), x["offset"].alias("offset"),
                        x["length"].alias("length"))).alias("mask"))


def parse(formatted: Column, template: Template = TEMPLATE) -> Column:
    """Array of (role, text) read back from a formatted string."""
    pieces = F.split(formatted, _literal(template.close), -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        at = F.instr(piece, template.middle)
        return F.struct(
            unescape(F.substring(piece, F.lit(len(template.open) + 1), at - 1 - len(template.open))).alias("role"),
            unescape(F.substring(piece, at + len(template.middle), F.length(piece))).alias("text"))

    return F.transform(pieces, turn)


def masked_text(formatted: Column, mask: Column, template: Template = TEMPLATE) -> Column:
    """The unescaped text under the loss mask, spans joined by nothing."""
    pieces = F.split(formatted, _literal(template.close), -1)
    return F.array_join(F.transform(mask, lambda s: unescape(
        F.substring(F.get(pieces, s["position"]), s["offset"] + 1, s["length"]))), "")


def _literal(marker: str) -> str:
    return r"\Q" + marker + r"\E"


def op2_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All conversations plus conversation -7, whose texts hold the template's own control strings."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], rows.schema)
    records = rows.unionByName(extra).select("conv_id", F.struct("turn", "role", "text").alias("record"))
    out = render(canonical_turns(records, "conv_id", "record"))
    loss = masked_text(F.col("formatted"), F.col("mask"))
    read = out.select("id", "formatted", "mask", parse(F.col("formatted")).alias("turns"), loss.alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


QUERIES = {"op2_chat_formatting": op2_chat_formatting}
ORACLE = {"op2_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(regexp_replace(role, '([\\#<])', '\\\1', 'g')) + length(regexp_replace(text, '([\\#<])', '\\\1', 'g'))
             + length('### ' || ' ###.' || ' </turn>.') AS n FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""}
