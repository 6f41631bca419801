"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn as

    <|im_start|>role NEWLINE content <|im_end|> NEWLINE

and reparsed by a deterministic parser.  A turn that doesn't come back as it
was is escaped, until the recovered turns are identical to the source.  In
content each marker, with the backslashes that follow its "<", gets one more
backslash, which the parser takes away; in roles backslashes, newlines and
marker beginnings are written \\\\, \\n and \\|.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
UNKNOWN_ROLE = "unknown"
_MARK = re.compile(r"<(\\*)\|im_(start|end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|im_(start|end)\|>")
_ROLE_CODE = re.compile(r"\\([\\n|])")


class GrammarError(ValueError):
    """The text is no sequence of turns."""


def escape_content(content: str) -> str:
    return _MARK.sub(r"<\\\1|im_\2|>", content)


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n").replace("<|", "<\\|")


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, content) turns of a rendered conversation."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(START, at):
            raise GrammarError(f"no turn begins at {at}")
        line = text.find("\n", at)
        if line < 0:
            raise GrammarError("a role doesn't end")
        role = text[at + len(START) : line]
        if START in role or END in role:
            raise GrammarError("a marker stands in a role")
        close = text.find(END, line + 1)
        if close < 0:
            raise GrammarError("a turn doesn't end")
        content = text[line + 1 : close]
        if START in content:
            raise GrammarError("a turn begins within a turn")
        at = close + len(END)
        if text[at : at + 1] != "\n":
            raise GrammarError("no newline after a turn")
        at += 1
        turns.append((_ROLE_CODE.sub(lambda m: "\n" if m[1] == "n" else m[1], role), _ESCAPED.sub(r"<\1|im_\2|>", content)))
    return turns


def _turn(role: str, content: str, escaped: bool) -> str:
    return f"{START}{escape_role(role) if escaped else role}\n{escape_content(content) if escaped else content}{END}\n"


def _comes_back(turn: tuple[str, str], escaped: bool) -> bool:
    try:
        return parse(_turn(*turn, escaped)) == [turn]
    except GrammarError:
        return False


def render(turns: list[tuple[str, str]]) -> tuple[str, int]:
    """(text, turns that had to be escaped)."""
    escaped: set[int] = set()
    while True:
        text = "".join(_turn(*t, i in escaped) for i, t in enumerate(turns))
        try:
            if parse(text) == turns:
                return text, len(escaped)
        except GrammarError:
            pass
        conflicting = {i for i, t in enumerate(turns) if i not in escaped and not _comes_back(t, False)}
        if not conflicting:
            raise GrammarError("escaping doesn't settle")
        escaped |= conflicting


def format_chats(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, rendered, n_turns and n_escaped of every conversation.

    Turns are in order of turn, role and text, those without a turn number
    last; repeated rows are turns of their own.  A null role is "unknown", a
    null text empty; the rows of null id are one conversation.
    """
    order = F.struct(F.col(turn).isNull().alias("late"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(UNKNOWN_ROLE)).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole = conversations.select(F.col(conv_id).alias("conv_id"), order.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns")).select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = batch.column("roles").to_pylist(), batch.column("texts").to_pylist()
            done = [render(list(zip(r, t))) for r, t in zip(roles, texts)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array([d[0] for d in done], pa.string()), pa.array([len(r) for r in roles], pa.int32()), pa.array([d[1] for d in done], pa.int32())], names=["conv_id", "rendered", "n_turns", "n_escaped"])

    return whole.mapInArrow(run, f"conv_id {whole.schema['conv_id'].dataType.simpleString()}, rendered string, n_turns int, n_escaped int")


def format_sql() -> str:
    content, role = r"<(\\*)\|im_(start|end)\|>", r"[\\\n]|<\|im_(start|end)\|>"
    return rf"""with t as (select conv_id, turn, coalesce(role, '{UNKNOWN_ROLE}') as role, coalesce(text, '') as text from conversations),
m as (select *, regexp_matches(text, '{content}') or regexp_matches(role, '{role}') as bad from t),
r as (select conv_id, turn, role, text, bad, '{START}' || case when bad then replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<|', '<\|') else role end || chr(10)
  || case when bad then regexp_replace(text, '{content}', '<\\\1|im_\2|>', 'g') else text end || '{END}' || chr(10) as line from m)
select conv_id, string_agg(line, '' order by turn nulls last, role, text) as rendered, count(*)::int as n_turns, count_if(bad)::int as n_escaped from r group by conv_id"""
