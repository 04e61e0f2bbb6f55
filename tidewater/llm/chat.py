r"""Chat formatting with a grammar round trip.

A turn is rendered as ``### Role: text </turn>`` and a line end.  Its grammar::

    turn := "### " role ": " body " </turn>" "\n"
    role := a capitalized known role | "=" (plain | escape)*
    body := (plain | escape)*        escape := "\" ("\" | "#" | "<" | ":" | "n")

where no plain text holds ``###`` or ``</turn>``.  The parser reads a turn from
left to right and needs nothing from the turns around it, so a conversation is
parsed turn by turn.  A text is rendered as it is, reparsed, and compared with
the source; where the two differ, conflicting strings are escaped, first the
control strings alone, then every special character, until they are identical.

Rows are shuffled once by conversation and sorted within the partitions by
turn; both passes then stream over the sorted rows and hold one batch and the
sums of the current conversation.  A conversation's turns are in one order, and
its digests run over that order, so its rows pass one task, but none of them
are gathered: a conversation with a third of all rows costs time in one task,
not memory.

Defined cases: null text is empty, null role is the empty role; rows of one
conversation with the same turn (null first) are ordered by role and text, and
repeated rows stay; a null conversation id is one conversation; an empty table
gives no rows.  Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ship

ROLES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
FROM_SHOWN = {v: k for k, v in ROLES.items()}
END = " </turn>\n"
#: The role whose text carries the loss.
LEARNED = "assistant"

#: Every repetition is possessive, so the parser keeps no mark per character;
#: the body runs up to the first control string, its last space included.
TURN = re.compile(
    r"### (?P<role>[A-Z][a-z]+|=(?:[^\\#<:\n]++|\\[\\#<:n])*+): "
    r"(?P<body>(?:[^\\#<]++|\\[\\#<:n]|\\|#(?!##)|<(?!/turn>))*+)</turn>\n")
ESCAPED = re.compile(r"\\([\\#<:n])")


def unescape(s: str) -> str:
    return ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], s)


def _control(s: str) -> str:
    return re.sub(r"\\(?=[\\#<:n])|###+|</turn>",
                  lambda m: m[0].replace("\\", "\\\\").replace("#", "\\#").replace("<", "\\<"), s)


def _special(s: str) -> str:
    return re.sub(r"[\\#<]", lambda m: "\\" + m[0], s)


def shown_role(role: str) -> str:
    return ROLES.get(role) or "=" + re.sub(
        r"[\\#<:\n]", lambda m: "\\n" if m[0] == "\n" else "\\" + m[0], role)


def parse_turn(s: str, at: int = 0) -> tuple[str, str, int] | None:
    """(role, text, end) of the turn that starts at ``at``; None if there is none."""
    m = TURN.match(s, at)
    if m is None or m["body"][-1:] != " " or (m["role"][0] != "=" and m["role"] not in FROM_SHOWN):
        return None
    role = unescape(m["role"][1:]) if m["role"][0] == "=" else FROM_SHOWN[m["role"]]
    return role, unescape(m["body"][:-1]), m.end()


def parse(s: str) -> list[tuple[str, str]]:
    """All turns of a formatted conversation."""
    out, at = [], 0
    while at < len(s):
        if (turn := parse_turn(s, at)) is None:
            raise ValueError(f"no turn at {at}")
        out.append(turn[:2])
        at = turn[2]
    return out


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """(rendered turn, start and end of its body): the least escaped form that
    the parser reads back as (role, text)."""
    head = f"### {shown_role(role)}: "
    for escape in (str, _control, _special):
        body = escape(text)
        out = head + body + END
        if parse_turn(out) == (role, text, len(out)):
            return out, len(head), len(head) + len(body)
    raise ValueError(f"no form of the turn parses back: {role!r}")


def format_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn, in order within its conversation and partition:
    conv_id, position, chunk (the rendered turn), and where in the whole
    formatted conversation (code points) the chunk starts and the loss mask
    begins and ends (equal outside assistant turns).

    Joining a conversation's chunks in order gives its formatted text.
    """
    ship(rows.sparkSession)
    ordered = (rows.select(F.col(conv).cast("string").alias("conv_id"), F.col(turn).alias("turn"),
                           F.coalesce(role, F.lit("")).alias("role"),
                           F.coalesce(text, F.lit("")).alias("text"))
               .repartition("conv_id")
               .sortWithinPartitions("conv_id", "turn", "role", "text"))

    def run(batches):
        now, k, at = object(), 0, 0
        for b in batches:
            out = []
            for c, r, t in zip(b["conv_id"], b["role"], b["text"], strict=True):
                if c != now:
                    now, k, at = c, 0, 0
                chunk, start, end = render_turn(r, t)
                if r != LEARNED:
                    end = start
                out.append((c, k, chunk, at, at + start, at + end))
                k, at = k + 1, at + len(chunk)
            yield pd.DataFrame(out, columns=names)

    names = ["conv_id", "position", "chunk", "start", "loss_start", "loss_end"]
    return _as_id(ordered.mapInPandas(
        run, "conv_id string, position long, chunk string, start long, loss_start long, "
             "loss_end long"), dict(rows.dtypes)[conv])


def _as_id(df: DataFrame, kind: str) -> DataFrame:
    """Ids pass pandas as strings: its integers have no null."""
    return df.withColumn("conv_id", F.col("conv_id").cast(kind))


def digests(formatted: DataFrame) -> DataFrame:
    """Read conversations back from ``format_turns`` (its partitions as they
    are): conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars."""
    ship(formatted.sparkSession)

    def run(batches):
        now, state = object(), None

        def done():
            turns, loss, n, chars, length = state
            return now, n, turns.hexdigest(), chars, loss.hexdigest(), length

        for b in batches:
            out = []
            for c, chunk, start, lo, hi in zip(b["conv_id"], b["chunk"], b["start"],
                                               b["loss_start"], b["loss_end"], strict=True):
                if c != now:
                    if state:
                        out.append(done())
                    now, state = c, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                role, text, end = parse_turn(chunk)
                if end != len(chunk):
                    raise ValueError("a chunk holds more than its turn")
                learned = unescape(chunk[lo - start:hi - start])
                state[0].update(f"{role}\n{text}\n".encode())
                state[1].update(learned.encode())
                state[2] += 1
                state[3] += len(learned)
                state[4] += len(chunk)
            yield pd.DataFrame(out, columns=names)
        if state:
            yield pd.DataFrame([done()], columns=names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = dict(formatted.dtypes)["conv_id"]
    return _as_id(_as_id(formatted, "string").mapInPandas(
        run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long"), kind)
