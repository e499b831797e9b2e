import hashlib
import random
from collections import Counter, defaultdict

from tripyard.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string, turns string, blocks string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)


def case():
    rng = random.Random(2)
    marks = ["</s>", "[INST]", "[/INST]", "<|im_end|>", "<|im_start|>user<|im_text|>", "<|im_sep|>", "\\", "<\\", "[\\", "\\\\<", "$1", "\n", "é中", "", " "]
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 9)):
            text = "".join(rng.choice([*marks, "word ", "ok"]) for _ in range(rng.randint(0, 8)))
            rows.append((c, t, rng.choice(["user", "assistant", "system", "<odd>", "a\\b", None]), rng.choice([text, text, None])))
    rows += [(None, 1, "user", "x"), (None, 0, "assistant", "y"), (70, None, "user", "n"), (70, None, "user", "n"), (70, 0, "assistant", None),
             (71, 5, "user", "same"), (71, 5, "assistant", "same"), (72, 0, "assistant", "long " * 50_000)]
    return rows


def brute(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t is not None, t or 0, role or "", text or ""))
    out = {}
    for c, own in convs.items():
        # escaped strings sort like the plain ones here only by (turn, role, text)
        own.sort(key=lambda r: (r[0], r[1], esc(r[2]), esc(r[3])))
        lines = "".join(f"{r}\n{t}\n" for _, _, r, t in own)
        learned = "".join(t for _, _, r, t in own if r == "assistant")
        formatted, last = "", None
        for _, _, r, t in own:
            if r == last:
                formatted = formatted[:-len(cf.END)] + cf.SEP + esc(t) + cf.END
            else:
                formatted += cf.START + esc(r) + cf.TEXT + esc(t) + cf.END
            last = r
        out[c] = (len(own), sha(lines), len(learned), sha(learned), len(formatted), formatted)
    return out


def esc(x):
    return "".join(ch + "\\" if ch in "<[\\" else ch for ch in x)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_formatting_and_reading_back(spark):
    rows = case()
    formatted = cf.format_conversations(table(spark, rows))
    want = brute(rows)
    assert {r["conv_id"]: r["formatted"] for r in formatted.collect()} == {c: w[5] for c, w in want.items()}
    assert {r[0]: tuple(r)[1:] for r in cf.digest(formatted).collect()} == {c: w[:5] for c, w in want.items()}


def test_control_strings_of_any_template_are_broken_up(spark):
    text = "</s>[INST] ok [/INST] <|im_end|>"
    got = cf.format_conversations(table(spark, [(1, 0, "user", text), (1, 1, "assistant", text)])).first()["formatted"]
    assert "</s>" not in got and "[INST]" not in got and "[/INST]" not in got and got.count(cf.END) == 2


def test_added_conversation(spark):
    got = cf.digest(cf.format_conversations(cf.with_control_case(spark, table(spark, [])))).collect()
    assert [(r["conv_id"], r["n_turns"], r["loss_chars"]) for r in got] == [(-7, 2, 21)]


def test_empty_table(spark):
    assert cf.format_conversations(table(spark, [])).collect() == []


def test_a_conversation_with_a_third_of_all_rows(spark):
    rows = [(0, i, ("user", "assistant")[i // 3 % 2], f"t{i}") for i in range(300)] + [(1 + i, 0, "user", "x") for i in range(600)]
    got = Counter(r["n_turns"] for r in cf.digest(cf.format_conversations(table(spark, rows))).collect())
    assert got == Counter({1: 600, 300: 1})
