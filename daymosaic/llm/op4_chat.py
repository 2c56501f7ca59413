"""Chat formatting: a finite-state machine over roles and a declarative template.

A template names the marks, the roles that may follow each role, those a
conversation may end with, and the roles whose text is learnt from. The machine
reads a conversation's roles in turn order and emits segments of text, each
with its loss flag: marks never count, the texts of learnt roles do.
Joined, the segments are the formatted conversation.

Control strings inside a role or text are escaped so that none is left in it:
the escape sign becomes two characters, and every place where a control string
begins is broken by an inserted pair. Both can be undone exactly.

A conversation is one output row, so one task holds it; conversations are
spread by id and formatted one after another.

Defined results: turns are ordered by (turn, role, text), nulls first, so ties
have one order; null texts and roles are empty; repeated rows are repeated
turns; rows with a null id are one conversation; a conversation whose roles
break the rules is formatted all the same, with ``valid`` false and the number
of turns the machine accepted; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymosaic.llm.tables import table

ESCAPE = "␛"
START = ""


@dataclass(frozen=True)
class Template:
    before_role: str = "<|turn|>"
    after_role: str = "<|says|>"
    after_text: str = "<|over|>\n"
    #: role (``START`` before the first turn) to the roles that may follow
    follows: tuple = (
        (START, ("system", "user")), ("system", ("user",)), ("user", ("assistant",)), ("assistant", ("user",)),
    )
    may_end: tuple = ("assistant",)
    learnt: tuple = ("assistant",)
    #: strings that other templates and tokenizers give a meaning to
    reserved: tuple = (
        "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>",
        "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>",
    )

    def control(self) -> tuple:
        return (self.before_role, self.after_role, self.after_text.rstrip("\n"), *self.reserved)

    def breaker(self) -> re.Pattern:
        return re.compile("(?=" + "|".join(re.escape(c) for c in self.control()) + ")(.)", re.S)


DEFAULT = Template()


def escape(text: str, breaker: re.Pattern) -> str:
    return breaker.sub(rf"\g<1>{ESCAPE}1", text.replace(ESCAPE, f"{ESCAPE}0"))


def unescape(text: str) -> str:
    return text.replace(f"{ESCAPE}1", "").replace(f"{ESCAPE}0", ESCAPE)


def accepted(roles: list[str], template: Template) -> tuple[int, bool]:
    """(turns the machine accepts, whether it accepts the conversation)."""
    follows, state = dict(template.follows), START
    for n, role in enumerate(roles):
        if role not in follows.get(state, ()):
            return n, False
        state = role
    return len(roles), state in template.may_end


def emit(turns: list[tuple[str, str]], template: Template, breaker: re.Pattern) -> list[tuple[str, bool]]:
    """Segments (text, counts for the loss) of (role, text) turns."""
    out = []
    for role, text in turns:
        out.append((f"{template.before_role}{escape(role, breaker)}{template.after_role}", False))
        out.append((escape(text, breaker), role in template.learnt))
        out.append((template.after_text, False))
    return out


def read_back(formatted: str, template: Template = DEFAULT) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns = []
    for part in formatted.split(template.before_role)[1:]:
        role, _, rest = part.partition(template.after_role)
        turns.append((unescape(role), unescape(rest[: len(rest) - len(template.after_text)])))
    return turns


SCHEMA = ("conv_id {id}, valid boolean, accepted_turns bigint, formatted string, "
          "segments array<struct<text: string, loss: boolean>>")
SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))


def format_chats(conversations: DataFrame, template: Template = DEFAULT, key: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: (conv_id, valid, accepted_turns, formatted, segments)."""
    kind = conversations.schema[key].dataType.simpleString()
    whole = conversations.select(
        F.col(key).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")).select(
        "conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(batches):
        breaker = template.breaker()
        for batch in batches:
            valid, n, formatted, segments = [], [], [], []
            for roles, texts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                count, ok = accepted(roles, template)
                own = emit(list(zip(roles, texts)), template, breaker)
                valid.append(ok)
                n.append(count)
                formatted.append("".join(t for t, _ in own))
                segments.append([{"text": t, "loss": x} for t, x in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(valid, pa.bool_()), pa.array(n, pa.int64()), pa.array(formatted, pa.string()),
                 pa.array(segments, SEGMENTS)],
                names=["conv_id", "valid", "accepted_turns", "formatted", "segments"])

    return whole.mapInArrow(run, SCHEMA.format(id=kind))


def digests(chats: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Turn count and digests, read back from the formatted text and the loss mask."""
    def run(batches):
        for batch in batches:
            rows = []
            for formatted, segments in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                turns = read_back(formatted, template)
                all_turns = "".join(f"{r}\n{t}\n" for r, t in turns)
                learnt, at = [], 0
                for s in segments:  # the mask lies on the formatted text
                    if s["loss"]:
                        learnt.append(unescape(formatted[at: at + len(s["text"])]))
                    at += len(s["text"])
                loss = "".join(learnt)
                rows.append((len(turns), hashlib.sha256(all_turns.encode()).hexdigest(), len(loss),
                             hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)], batch.column(3)],
                names=["conv_id", *names, "valid"])

    kind = chats.schema["conv_id"].dataType.simpleString()
    return chats.select("conv_id", "formatted", "segments", "valid").mapInArrow(
        run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
             "formatted_chars bigint, valid boolean")


#: a conversation whose texts are made of control strings
PROBE = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return digests(format_chats(given.unionByName(probe)))


def _sql() -> str:
    marks = DEFAULT.before_role + DEFAULT.after_role + DEFAULT.after_text

    def widened(c: str) -> str:  # each escape sign adds one character, each control string two
        found = " + ".join(f"(length({c}) - length(replace({c}, '{x}', ''))) // {len(x)}" for x in DEFAULT.control())
        return f"length({c}) + length({c}) - length(replace({c}, '{ESCAPE}', '')) + 2 * ({found})"

    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')),
 c AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
    string_agg(role, ',' ORDER BY turn NULLS FIRST, role, text) AS roles,
    sum({len(marks)} + {widened("role")} + {widened("text")}) AS formatted_chars FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
    CAST(formatted_chars AS BIGINT) AS formatted_chars,
    regexp_full_match(roles, '(system,)?user,assistant(,user,assistant)*') AS valid FROM c"""


SQL = _sql()
