"""Chat formatting: a finite-state machine over roles, a declarative template, segments with loss flags.

A template is data: the strings around a turn, the control strings that texts may not contain, which roles bear loss, and
the allowed next roles of each state. Formatting walks the turns in order of (turn, role, text) and emits segments
(text, loss); their concatenation is the formatted conversation. Inside texts each control string gets the escape
character after its first character, and control strings that already hold escape characters there get one more, so that
`unescape(escape(t)) == t` for any text and no control string occurs in an escaped text. Roles are percent-encoded.
`read_back` parses a formatted conversation again.

Rows of one conversation are gathered into one formatted string: that is the result, and its size is that of the
conversation. Nulls: a null text is empty, a null role is the empty role, a null turn sorts first; a null conv_id is a
conversation of its own. A conversation that the machine refuses is still formatted, with valid false and the position
of the first refused turn. Repeated rows are turns of their own; rows that tie in turn, role and text are equal. Texts of any
length are kept whole. Other columns are ignored. An empty table gives an empty result. Only DataFrame functions are used.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ESCAPE = "\u241b"


@dataclass(frozen=True)
class Template:
    """Each turn reads turn_open + role + role_close + text + turn_close."""

    turn_open: str = "<|turn|>"
    role_close: str = "\n"
    turn_close: str = "<|end|>\n"
    controls: tuple[str, ...] = ("<|turn|>", "<|end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant",),
        }
    )
    final: tuple[str, ...] = ("assistant",)


CHAT = Template()


def _quote(s: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()<>*+-=!?^$|/" else c for c in s)


def _tails(template: Template) -> dict[str, str]:
    """For each first character of control strings, an alternation of what may follow it, longer ones first."""
    heads: dict[str, list[str]] = {}
    for c in sorted(template.controls, key=len, reverse=True):
        heads.setdefault(c[0], []).append(_quote(c[1:]))
    return {_quote(h): "|".join(rest) for h, rest in heads.items()}


def escape(text: Column, template: Template = CHAT) -> Column:
    """One more escape character after the first character of each control string, escaped or not."""
    pattern = "|".join(f"(?<={h})(?={ESCAPE}*(?:{rest}))" for h, rest in _tails(template).items())
    return F.regexp_replace(text, pattern, ESCAPE)


def unescape(text: Column, template: Template = CHAT) -> Column:
    pattern = "|".join(f"(?<={h}){ESCAPE}(?={ESCAPE}*(?:{rest}))" for h, rest in _tails(template).items())
    return F.regexp_replace(text, pattern, "")


def _segments(turns: Column, template: Template) -> Column:
    """Three segments a turn: what opens it, the escaped text, what closes it; loss only on texts of loss roles."""

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of(t: Column) -> Column:
        return F.array(
            piece(F.concat(F.lit(template.turn_open), F.url_encode(t["role"]), F.lit(template.role_close)), F.lit(False)),
            piece(t["text"], t["role"].isin(*template.loss_roles)),
            piece(F.lit(template.turn_close), F.lit(False)),
        )

    return F.flatten(F.transform(turns, of))


def _refused(turns: Column, template: Template) -> Column:
    """Position of the first turn that the machine refuses; the number of turns if the last one is no final state; else null."""
    state = F.lit(template.start)
    before = F.concat(F.array(state), F.transform(turns, lambda t: t["role"]))
    ok = F.lit(False)
    steps = F.arrays_zip(before.alias("at"), F.transform(turns, lambda t: t["role"]).alias("to"))

    def allowed(s: Column) -> Column:
        out = ok
        for at, to in template.moves.items():
            out = out | ((s["at"] == at) & s["to"].isin(*to))
        return out

    bad = F.array_position(F.transform(F.slice(steps, F.lit(1), F.size(turns)), lambda s: F.coalesce(allowed(s), F.lit(False))), F.lit(False))
    last = F.element_at(before, -1)
    return F.when(bad > 0, bad - 1).when(~last.isin(*template.final), F.size(turns).cast("long"))


def format_conversations(rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, segments, formatted, valid, refused_at of each conversation in rows(conv_id, turn, role, text)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    escaped = lambda t: F.struct(t["turn"].alias("turn"), t["role"].alias("role"), escape(t["text"], template).alias("text"))
    return (
        rows.select("conv_id", turn.alias("t"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
        .withColumn("turns", F.transform("turns", escaped))  # after the order, which is that of the plain texts
        .withColumn("segments", _segments(F.col("turns"), template))
        .withColumn("refused_at", _refused(F.col("turns"), template))
        .select(
            "conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
            F.col("refused_at").isNull().alias("valid"), "refused_at",
        )
    )


def read_back(formatted: Column, template: Template = CHAT) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.filter(F.split(formatted, _quote(template.turn_open)), lambda p: p != "")

    def turn(p: Column) -> Column:
        role = F.substring_index(p, template.role_close, 1)
        start = F.length(role) + len(template.role_close)
        text = F.substr(p, start + 1, F.length(p) - start - len(template.turn_close))
        return F.struct(F.url_decode(role).alias("role"), unescape(text, template).alias("text"))

    return F.transform(pieces, turn)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    done = format_conversations(rows.unionByName(extra))
    turns = F.col("turns")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return (
        done.withColumn("turns", read_back(F.col("formatted")))
        .withColumn("loss_text", loss)
        .select(
            "conv_id",
            F.size(turns).cast("long").alias("n_turns"),
            F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
            F.length("loss_text").cast("long").alias("loss_chars"),
            F.sha2("loss_text", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "valid",
        )
    )


QUERIES = {"op5_chat_format": op5_chat_format}

ORACLES = {
    "op5_chat_format": """
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), marked AS (
            SELECT *, regexp_replace(regexp_replace(text,
                '(<)(\u241b*(?:\\|endoftext\\|>|\\|turn\\|>|\\|end\\|>|</SYS>>|<SYS>>|/s>|s>))', '\\1\u241b\\2', 'g'),
                '(\\[)(\u241b*(?:/INST\\]|INST\\]))', '\\1\u241b\\2', 'g') AS escaped,
                lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
                lead(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS after
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(17 + length(role) + length(escaped)) AS BIGINT) AS formatted_chars,
            bool_and(CASE coalesce(before, 'start')
                WHEN 'start' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user' WHEN 'user' THEN role = 'assistant'
                WHEN 'assistant' THEN role IN ('user', 'tool') WHEN 'tool' THEN role = 'assistant' ELSE false END
                AND (after IS NOT NULL OR role = 'assistant')) AS valid
        FROM marked GROUP BY conv_id
    """
}
