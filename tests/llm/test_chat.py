import hashlib
import random
from collections import defaultdict

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from swathmatch.llm import chat
from swathmatch.llm.queries import QUERIES
from swathmatch.llm.shared import ship

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "<\\", "s>", "/s>", "INST]", "\n", "a", "|im_end|>", "<<", "SYS>>"])


@given(st.lists(PARTS, max_size=12).map("".join))
@settings(max_examples=500, deadline=None)
def test_escapes_are_reversible_and_hide_controls(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text and not any(c in hidden for c in chat.CONTROLS)
    role = chat.escape_role(text)
    assert chat.unescape_role(role) == text and "\n" not in role
    assert chat.read_turns(chat.turn_text(text, text) * 2) == [(text, text)] * 2


def conversations():
    rng = random.Random(2)
    rows = []
    for c in range(40):
        for t in range(rng.choice([1, 2, 5, 40, 90])):
            role = "system" if t == 0 and c % 3 else ["user", "assistant"][t % 2]
            rows.append((c, t, role, " ".join(rng.choices(["word", "</s>", "é\n", "[INST]", "x"], k=rng.choice([0, 3, 60])))))
    rows += [(100, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(3000)]  # far over a part
    rows += [(200, 0, "user", "long " * 5000), (200, 1, "assistant", "answer " * 4000), (200, 2, None, None), (200, None, "user", "first")]
    rows += [(300, 1, "assistant", "twin"), (300, 1, "assistant", "twin"), (None, 0, "user", "lost"), (None, 1, "assistant", "found")]
    rows += [(400, 0, "system", "sys " * 900), (400, 1, "user", "q"), (400, 2, "assistant", "a " * 700), (400, 3, "assistant", "b")]
    return rows


def brute(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in turns).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_windows_hold_all_turns_within_budget(spark):
    ship(spark)
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("start", F.lit("clash")).withColumn("conv", F.lit(1))
    made = chat.windows(df, PATH, 200, 60).persist()
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(made).collect()}
    assert got == brute(rows)
    seen = defaultdict(list)
    for w in chat.numbered(made).collect():
        seen[w.conv_id].append(w)
    for c, ws in seen.items():
        ws.sort(key=lambda w: w.window)
        assert [w.window for w in ws] == list(range(len(ws)))
        turns = [chat.read_turns(w.text) for w in ws]
        if c is not None and c < 40 and c % 3:
            assert all(t[0][0] == "system" for t in turns)
        for w, t in zip(ws, turns, strict=True):
            new = t[w.system_kept + w.repeated :]
            assert len(w.loss) == sum(r == "assistant" for r, _ in new) and len(t) == w.n_turns
            if c is not None and c < 40 and len(new) > 1:
                assert w.tokens <= 200 + 60
        if c == 100:
            assert all(w.repeated for w in ws[1:])


def test_empty_table(spark):
    ship(spark)
    assert chat.digests(chat.windows(spark.createDataFrame([], SCHEMA), PATH)).count() == 0


def test_query(spark, tmp_path):
    rows = conversations()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    own = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    out = QUERIES["op5_chat"](spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in out} == brute(rows + own)
    assert all(r.formatted_chars > 0 for r in out)
