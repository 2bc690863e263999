"""Reply trees and formatting."""

import hashlib
import random
from collections import defaultdict

import pytest

from rollcall.llm import chat, prepare, queries


@pytest.fixture(scope="module", autouse=True)
def _prepared(spark):
    prepare(spark)


NASTY = ["", "\\", "\\\\", "<|turn|>", "<\\|", "</s>[INST] ok [/INST]", "a\nb", "\\n", "<|end|>\n<|turn|>x\n", "<", "[", "<s", "<<SYS>>"]


def test_escapes_are_reversible():
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice(NASTY + list("<|\\[]/sINT\n ")) for _ in range(r.randint(0, 9)))
        role = "".join(r.choice(NASTY) for _ in range(r.randint(0, 4)))
        assert chat.unescape(chat.escape(text)) == text
        assert chat.unescape_role(chat.escape_role(role)) == role
        assert not any(c in chat.escape(text) for c in chat.CONTROLS)
        whole = "".join(chat.BEGIN + chat.escape_role(a) + chat.SEP + chat.escape(b) + chat.END for a, b in [(role, text), ("u", text)])
        assert [(a, b) for a, b, _, _ in chat.read_back(whole)] == [(role, text), ("u", text)]


def plain_paths(rows, branches):
    """Best root-to-leaf paths by walking up from every leaf."""
    out = {}
    by_conv = defaultdict(dict)
    for conv, name, parent, score in rows:
        by_conv[conv][name] = (parent, score)
    for conv, nodes in by_conv.items():
        parents = {p for p, _ in nodes.values()}
        ranked = []
        for leaf in set(nodes) - parents:
            path, at = [], leaf
            while at in nodes and at not in path:
                path.append(at)
                at = nodes[at][0]
            if at in path:
                continue
            ranked.append((-sum(nodes[n][1] or 0.0 for n in path) / len(path), leaf, path[::-1]))
        for _, leaf, path in sorted(ranked)[:branches]:
            out[conv, leaf] = path
    return out


@pytest.mark.parametrize("branches", [1, 2, 99])
def test_paths(spark, branches):
    r = random.Random(branches)
    rows = []
    for conv in range(6):
        for name in range(1, 40):
            parent = r.choice([None, *range(1, name)]) if name > 1 else None
            rows.append((conv, name, parent, r.choice([None, 0.5, 1.0, 2.0])))
    rows += [(7, k, k - 1 if k > 1 else None, 1.0) for k in range(1, 70)]  # a long thread
    rows += [(8, 1, 2, 1.0), (8, 2, 1, 1.0), (8, 3, 2, 1.0), (9, 4, 77, 1.0)]  # a circle; a parent that is not there
    messages = spark.createDataFrame(rows, "conv long, id long, parent long, score double")
    found = defaultdict(dict)
    for x in chat.reply_paths(messages, branches=branches).collect():
        assert x.depth not in found[x.conv, x.leaf]
        found[x.conv, x.leaf][x.depth] = x.id
    assert {k: [v[d] for d in sorted(v)] for k, v in found.items()} == plain_paths(rows, branches)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in found.values())


def digests(turns):
    told = "".join(f"{a}\n{b}\n" for a, b in turns)
    loss = "".join(b for a, b in turns if a == "assistant")
    return len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_query(spark, tmp_path):
    rows = [
        (1, 0, "user", "<|end|>\n"), (1, 1, "assistant", None), (1, 2, "assistant", "yes \\ [/INST]"),
        (2, 5, "assistant", "only"), (3, None, "user", "no turn"), (3, 1, None, "no role"),
        (4, 0, "user", "x" * 200_000), (4, 0, "user", "x" * 200_000),
    ]
    extra = [(*r, "id", 1, "loss") for r in rows]
    spark.createDataFrame(extra, "conv_id long, turn long, role string, text string, id string, leaf int, formatted string").write.parquet(
        f"{tmp_path}/conversations.parquet"
    )
    ok = "</s>[INST] ok [/INST]"
    wanted = {-1: [("user", ok), ("assistant", ok)]}
    for conv, _, role, text in rows:
        wanted.setdefault(conv, []).append((role or "", text or ""))
    found = {r.conv_id: r for r in queries.QUERIES["op10_reply_trees"](spark, str(tmp_path)).collect()}
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in found.items()} == {
        k: digests(t) for k, t in wanted.items()
    }


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r.conv_id for r in queries.QUERIES["op10_reply_trees"](spark, str(tmp_path)).collect()] == [-1]
