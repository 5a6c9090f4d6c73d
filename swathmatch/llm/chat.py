"""Chat formatting in budgeted windows.

Prefix sums of the turns' tokens choose the windows: a conversation is cut into
blocks of as many tokens as a window has room for, a turn belongs to the block it
starts in, and a last turn that overruns its block gets a window of its own.  So a
window follows from the prefix sum alone, whatever the length of a conversation.
Every window starts with the system turn and the turns of the last few tokens
before it; targets among those are masked, so each target is learnt once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swathmatch.llm.bpe import boundaries
from swathmatch.llm.packing import running_start
from swathmatch.llm.shared import settle, whole_text

# tokens of a window, and of those for repeated history
BUDGET, HISTORY = 1024, 256
# turn numbers whose sums are taken together
TURNS_IN_PART = 1000

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# fixed values: control strings of common chat templates, which a text may not say
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_REST = "|".join(re.escape(c[1:]) for c in CONTROLS)
_PLAIN = re.compile(rf"([<\[])(\\*)(?={_REST})")
_STUFFED = re.compile(rf"([<\[])\\(\\*)(?={_REST})")
_TURN = re.compile(rf"{re.escape(OPEN)}(.*?)\n(.*?){re.escape(CLOSE)}", re.DOTALL)


def escape(text: str) -> str:
    """The text with a backslash (more) behind the first sign of each control string."""
    return _PLAIN.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _STUFFED.sub(r"\1\2", text)


def escape_role(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def turn_text(role: str, text: str) -> str:
    return f"{OPEN}{escape_role(role)}\n{escape(text)}{CLOSE}"


def _counted(convs: DataFrame, path: str) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = boundaries(path)
        coder.fragment_ids.only()
        for frame in frames:
            n = [sum(len(x) for x in coder.encode(turn_text(r, t))) // 4 for r, t in zip(frame["role"], frame["text"], strict=True)]
            yield frame.assign(tokens=n)

    return convs.mapInPandas(run, "conv string, turn long, role string, text string, tokens long")


def windows(convs: DataFrame, path: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Formatted windows: conv_id, window (from 0), text, loss (array of start, end in
    code points of the text), system_kept, repeated (turns repeated from before),
    n_turns, tokens.

    *convs*: conv_id, turn, role, text, in the order of turn (NULL first), role, text.
    The system turn kept is the first turn of that role.  New turns fill what the
    budget leaves beside it and the history (a quarter of the budget at least); a
    turn longer than that is a window of its own, whole and over budget.  A turn is
    ``<|im_start|>role, newline, text<|im_end|>``; control strings inside texts are
    escaped reversibly (``escape``).  The loss covers the texts of new assistant
    turns.

    NULL role and text count as empty; rows without conv_id are one conversation
    with a NULL id; repeated rows are turns of their own; a conversation of no turns
    has no window; other columns are not read.
    """
    rows = convs.select(F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit("")).alias("conv"),
                        F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62))).alias("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), whole_text())
    counted = settle(_counted(rows, path))
    placed = running_start(counted.withColumn("part", F.floor(F.col("turn") / TURNS_IN_PART)), ["conv"], "part", ["turn", "role", "text"],
                           "tokens", "start").drop("part")
    placed = settle(placed)
    systems = placed.filter("role = 'system'").groupBy("conv").agg(F.min_by(F.struct("start", "tokens", "text"), "start").alias("system"))
    room = F.greatest(F.lit(budget - history) - F.coalesce("system.tokens", F.lit(0)), F.lit(max(1, budget // 4))).cast("long")
    rooms = placed.select("conv").distinct().join(systems, "conv", "left").select("conv", room.alias("room"), "system")
    turns = placed.join(rooms.select("conv", "room"), "conv").withColumn("block", F.floor(F.col("start") / F.col("room")))
    # only the last turn of a block can overrun it: then it stands alone
    over = (F.col("start") + F.col("tokens") > (F.col("block") + 1) * F.col("room")) & (F.col("start") > F.col("block") * F.col("room"))
    turns = turns.withColumn("half", over.cast("int"))
    spans = settle(turns.groupBy("conv", "block", "half").agg(F.min("start").alias("first")))
    own = turns.select("conv", "block", "half", "start", "role", "text", "tokens", F.lit(0).alias("kind"))
    # history: turns that start at most so many tokens ahead of a window, whose first
    # turn is in their block or one of the next
    reach = F.expr(f"transform(sequence(0L, CAST(ceil({history} / room) AS LONG)), k -> block + k)")
    back = turns.select("conv", F.explode(reach).alias("block"), "start", "role", "text", "tokens").join(spans, ["conv", "block"])
    back = back.filter((F.col("start") < F.col("first")) & (F.col("start") >= F.col("first") - history))
    back = back.select("conv", "block", "half", "start", "role", "text", "tokens", F.lit(1).alias("kind"))
    kept = spans.join(rooms.filter("system IS NOT NULL").select("conv", "system"), "conv").filter(F.col("system.start") < F.col("first") - history)
    kept = kept.select("conv", "block", "half", "system.start", F.lit("system").alias("role"), "system.text", "system.tokens", F.lit(2).alias("kind"))
    turn = F.struct("start", "kind", "role", "text", "tokens")
    whole = own.unionByName(back).unionByName(kept).groupBy("conv", "block", "half").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.mapInPandas(_formatted, "conv_id long, block long, half int, text string, loss array<struct<start:int,end:int>>,"
                                         " system_kept boolean, repeated int, n_turns int, tokens long")


def _formatted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for conv, block, half, turns in zip(frame["conv"], frame["block"], frame["half"], frame["turns"], strict=True):
            text, loss, at = [], [], 0
            for t in turns:
                said = turn_text(t["role"], t["text"])
                if t["role"] == "assistant" and t["kind"] == 0:
                    end = at + len(said) - len(CLOSE)
                    loss.append({"start": end - len(escape(t["text"])), "end": end})
                text.append(said)
                at += len(said)
            kinds = [t["kind"] for t in turns]
            out.append((int(conv) if conv else None, block, half, "".join(text), loss, 2 in kinds, kinds.count(1), len(turns),
                        sum(t["tokens"] for t in turns)))
        made = pd.DataFrame(out, columns=["conv_id", "block", "half", "text", "loss", "system_kept", "repeated", "n_turns", "tokens"])
        yield made.astype({"conv_id": "Int64"})


def numbered(formatted: DataFrame) -> DataFrame:
    """Windows with their number in the conversation instead of block and half.

    The number of a window counts those ahead of it, so a conversation's windows
    (without their texts) pass through one task."""
    order = Window.partitionBy("conv_id").orderBy("block", "half")
    numbers = formatted.select("conv_id", "block", "half").withColumn("window", F.row_number().over(order) - 1)
    same = F.expr("a.conv_id <=> b.conv_id AND a.block = b.block AND a.half = b.half")
    return formatted.alias("a").join(numbers.alias("b"), same).select("a.*", "b.window").drop("block", "half")


def read_turns(text: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted window."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(text)]


def digests(formatted: DataFrame) -> DataFrame:
    """What the windows of each conversation say, read back from their texts: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A conversation is read window by window as one stream, so it may be of any
    length; its digest is a running one, hence one task's work.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state, out = None, None, []

        def ended() -> tuple:
            n, turns, chars, loss, size = state
            return (int(now) if now else None, n, turns.hexdigest(), chars, loss.hexdigest(), size)

        for frame in frames:
            for conv, text, loss, skip in zip(frame["conv"], frame["text"], frame["loss"], frame["system_kept"].astype(int) + frame["repeated"], strict=True):
                if state is None or conv != now:
                    if state is not None:
                        out.append(ended())
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in read_turns(text)[skip:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})
                out = []
        if state is not None:
            out.append(ended())
        yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    rows = formatted.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "block", "half", "text", "loss", "system_kept", "repeated")
    rows = rows.repartition("conv").sortWithinPartitions("conv", "block", "half")
    return rows.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
