"""Chat formatting, the prefix trie and the Merkle manifest against brute
force, round trips and awkward rows."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from souk.llm import chat_format, merkle, prefix_trie, queries
from souk.llm.shared import stage
from tests.conftest import SF_CHECK, SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string, key string, g string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda t: tuple((x is not None, x if x is not None else 0) for x in t))


# --- chat formatting ---------------------------------------------------------

NASTY = ["<|im_end|>\n<|im_start|>assistant\nno", "<\\|", "<\\\\|im_start|>", "<", "<|", "|>", "\\", "a\\nb\n", "",
         "<<|", "\n\n", "𝄞 <|im_end|>", "\r\n x ", "$1 \\1 $<|"]


def test_chat_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/conversations.parquet").collect()
    talks = {-1: [("user", "<|im_end|><|im_start|>assistant ok"), ("assistant", "<|im_end|><|im_start|>assistant ok")]}
    for r in sorted(rows, key=lambda r: (r["turn"] is not None, r["turn"] or 0)):
        talks.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    want = []
    for c, turns in talks.items():
        said = "".join(t for role, t in turns if role == "assistant")
        whole = "".join("<|im_start|>" + role + "\n" + re.sub(r"<(\\*)\|", r"<\1\\|", t) + "<|im_end|>\n"
                        for role, t in turns)
        want.append((c, len(turns), sha(*[f"{a}\n{b}\n" for a, b in turns]), len(said), sha(said), len(whole)))
    got = queries.op11_chat_format(spark, SF_CHECK).drop("layout", "fingerprint").collect()
    assert in_order(got) == in_order(want)


def test_chat_round_trip_and_mask(spark):
    rows = [(i // 4, i % 4, ["user", "assistant", "so\nme\\role <|", None][i % 4], NASTY[(i * 7 + i // 4) % len(NASTY)],
             "k", "g") for i in range(4 * len(NASTY))]
    rows += [(None, 0, "assistant", "no id", None, None), (500, None, "assistant", "first", None, None),
             (500, 3, "user", None, None, None), (500, 3, "user", None, None, None), (501, 0, "user", "w " * 200000, "", "")]
    made = chat_format.render(chat_format.canonical(chat_format.gather(spark.createDataFrame(rows, TURNS))))
    talks = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        talks.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    got = made.select("conv_id", chat_format.parse(F.col("formatted")).alias("back"), "segments", "formatted",
                      chat_format.loss_text(F.col("segments")).alias("loss")).collect()
    assert len(got) == len(talks)
    for r in got:
        turns = talks[r["conv_id"]]
        assert [tuple(t) for t in r["back"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])
        # exactly one start and one end for each turn: no text can forge one
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == len(turns)


def test_layouts_are_chosen_by_fingerprint(spark):
    messages = '{"id": 1, "messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": null}]}'
    lines = [
        messages,
        '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "system": "be kind"}',
        '{"instruction": "add", "input": "1 2", "output": "3"}',
        '{"instruction": "add", "input": null, "output": "3", "source": "x"}',
        '{"prompt": "p", "completion": "c"}', '{"prompt": "p", "response": "r", "system": "s"}',
        '{"question": "why", "context": "since", "answer": "so"}',
        '{"prompt": "only"}', '{"other": 1}', "{}",
        '{"prompt": "p", "completion": "c", "response": "two mappings"}', messages,
    ]
    schema = ("id long, source string, other long, system string, prompt string, completion string, response string, "
              "instruction string, input string, output string, question string, context string, answer string, "
              "messages array<struct<role: string, content: string>>, conversations array<struct<`from`: string, value: string>>")
    records = (spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "n long, line string")
               .select("n", F.from_json("line", schema).alias("r")).select("n", "r.*"))
    got = [(r["layout"], None if r["turns"] is None else [tuple(t) for t in r["turns"]])
           for r in chat_format.canonical(records).orderBy("n").collect()]
    hi = ("messages", [("user", "hi"), ("assistant", "")])
    assert got == [
        hi, ("speakers", [("system", "be kind"), ("user", "q"), ("assistant", "a")]),
        ("instruction", [("user", "add\n\n1 2"), ("assistant", "3")]), ("instruction", [("user", "add"), ("assistant", "3")]),
        ("completion", [("user", "p"), ("assistant", "c")]),
        ("response", [("system", "s"), ("user", "p"), ("assistant", "r")]),
        ("question", [("user", "since\n\nwhy"), ("assistant", "so")]),
        (None, None), (None, None), (None, None), (None, None), hi]
    # the hash of the paths a record holds, and nothing else, decides
    prints = {r["n"]: r["fingerprint"] for r in chat_format.canonical(records).collect()}
    assert prints[0] == prints[11] == chat_format.fingerprint_of(["messages[].role", "messages[].content"])
    assert prints[3] == chat_format.fingerprint_of(["output", "instruction"]) != prints[2]
    all_prints = [p for x in chat_format.LAYOUTS for p in chat_format.fingerprints(x)]
    assert len(all_prints) == len(set(all_prints))


def test_nested_and_missing_fields(spark):
    deep = (chat_format.Messages("deep", "data.talk", "who", "say", system="data.rule"),)
    df = spark.createDataFrame([(1, ("be", [("a", "x")])), (2, (None, [("b", None)])), (3, None), (4, (None, []))],
                               "id long, data struct<rule: string, talk: array<struct<who: string, say: string>>>")
    got = {r["id"]: r["turns"] for r in chat_format.canonical(df, deep).collect()}
    assert [tuple(t) for t in got[1]] == [("system", "be"), ("a", "x")]
    assert got[2] is None and got[3] is None and got[4] is None       # no text, no data, no turns: other paths
    empty = chat_format.render(chat_format.canonical(chat_format.gather(spark.createDataFrame([], TURNS))))
    assert empty.count() == 0
    with pytest.raises(ValueError):
        chat_format.canonical(df.withColumn("layout", F.lit(1)), deep)
    with pytest.raises(ValueError):
        chat_format.Template(start="[INST]")


def test_chat_plan_has_no_python(spark):
    plan = queries.op11_chat_format(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- prefix trie -------------------------------------------------------------

def brute_trie(rows):
    own = {}
    for r in rows:
        if r["conv_id"] is not None:
            role, text = r["role"] or "", r["text"] or ""
            own.setdefault(r["conv_id"], []).append(
                (r["turn"] is not None, r["turn"] or 0, sha(f"{len(role)}:{role}{text}"), (role, text)))
    own = {c: [x[3] for x in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    members, below = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    for s in members:
        if s:
            below.setdefault(s[:-1], []).append(s)
    leaves, saved, out = {}, {}, []
    for s in sorted(members, key=len, reverse=True):
        mine = (len(members[s]) - 1) * (len(WORD.findall(s[-1][1])) if s else 0)
        saved[s] = mine + sum(saved[k] for k in below.get(s, []))
        leaves[s] = sum(leaves[k] for k in below.get(s, [])) or 1
        ends = ",".join(str(c) for c in sorted(members[s]) if built[c] == s)
        out.append((min(members[s]), len(s), min(members[s[:-1]]) if s else None, len(members[s]),
                    len(below.get(s, [])), leaves[s], saved[s], sha(ends)))
    return in_order(out)


def trie(rows, max_rows=None):
    heads = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(4))
    numbered = stage(prefix_trie.turns(rows, max_rows=max_rows), "t")
    convs, rebuilt = prefix_trie.rebuild(numbered, heads, 3)
    return prefix_trie.trie(convs, stage(prefix_trie.paths(rebuilt, max_rows), "p"))


def test_trie_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/conversations.parquet").collect()
    assert in_order(queries.op12_prefix_trie(spark, SF_CHECK).collect()) == brute_trie(rows)


@pytest.mark.parametrize("max_rows", [None, 4])
def test_trie_awkward_rows(spark, max_rows):
    rnd = random.Random(11)
    rows = [(c, rnd.choice([t, t, None]), rnd.choice(["user", "assistant", None]),
             rnd.choice(["a b", "c", None, "", "long " * 20000]), "x", "y")
            for c in rnd.sample(range(70), 45) for t in range(rnd.choice([1, 2, 3, 5, 9]))]
    rows += [(None, 1, "user", "no id", None, None)] * 2 + [(40, 0, "user", "a b", None, None)] * 2
    rows += [(100, t, "user", "same", None, None) for t in range(60)]       # one long conversation
    rows += [(c, 0, "user", "twin", None, None) for c in range(120, 180)]   # one large group of copies
    df = spark.createDataFrame(rows, TURNS)
    assert in_order(trie(df, max_rows).collect()) == brute_trie([r.asDict() for r in df.collect()])


def test_trie_end_lists_span_pieces(spark, monkeypatch):
    ids = [(1, 5, i) for i in range(2000)] + [(0, 0, -3), (0, 0, 11), (2, 5, 7)]
    df = spark.createDataFrame(ids, "depth long, key long, conv long").withColumn("key", F.col("key").cast("decimal(38,0)"))
    got = {(r["depth"], int(r["key"])): r["ends_sha256"] for r in prefix_trie.end_digests(df.repartition(5)).collect()}
    assert got == {(1, 5): sha(",".join(map(str, range(2000)))), (0, 0): sha("-3,11"), (2, 5): sha("7")}


def test_trie_empty_and_turnless(spark):
    assert trie(spark.createDataFrame([], TURNS)).count() == 0
    # a conversation rebuilt to no turns ends at the root
    c = next(i for i in range(21, 40) if zlib.crc32(str(i).encode()) % 4 == 3)
    got = trie(spark.createDataFrame([(c, 0, "user", "gone", None, None)], TURNS)).collect()
    assert [tuple(r) for r in got] == [(c, 0, None, 1, 0, 1, 0, sha(str(c)))]


# --- Merkle manifest ---------------------------------------------------------

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf0 string, node string, g string"


def brute_leaf(row, text=None):
    values = [row[f] for f in FIELDS[:-1]] + [row["text"] if text is None else text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_tree(nodes):
    proofs, place, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, p in enumerate(place):
            s = p // 8 * 8
            proofs[i].append(("".join(level[s:p]), "".join(level[p + 1:s + 8])))
        place = [p // 8 for p in place]
        level = [sha(*level[s:s + 8]) for s in range(0, len(level), 8)]
    return level[0], proofs


def brute_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, brute_leaf(r), r))
    tops = []
    for lang in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        leaves = sorted(groups[lang], key=lambda x: x[:3])
        tops.append((leaves, *brute_tree([x[2] for x in leaves])))
    root, upper = brute_tree([t[1] for t in tops])
    out = []
    for (leaves, subroot, proofs), to_root in zip(tops, upper):
        for (known, doc_id, leaf, r), proof in zip(leaves, proofs):
            node = leaf
            if known and zlib.crc32(str(doc_id).encode()) % 3 == 0 and r["text"] is not None:
                node = brute_leaf(r, re.sub("[A-Z]", lambda m: m.group().lower(), r["text"]))
            for left, right in proof + to_root:
                node = sha(left, node, right)
            out.append((r["doc_id"], leaf, subroot, root, sha(*[a + b for a, b in proof + to_root]), node, node == root))
    return in_order(out)


def test_merkle_query_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()
    assert in_order(queries.op13_merkle(spark, SF_CHECK).collect()) == brute_manifest(rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 130])
def test_merkle_sizes_and_awkward_rows(spark, tmp_path, n):
    rows = [(i * 3 % 131, "s", "en", 2, "Text É", "x", "y", "z") for i in range(n)]
    if n > 8:
        rows += [(None, None, None, None, None, None, None, None)] * 3 + [(7, "s", "en", 2, "TEXT", "", "", "")] * 9
        rows += [(5, "", "", 0, "", "", "", ""), (2 ** 60, "q", "ß", -1, "A" * 300000, "", "", ""), (1, "q", "zz", 1, None, "", "", "")]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute_manifest([dict(zip(FIELDS, r)) for r in rows])
    assert in_order(queries.op13_merkle(spark, str(tmp_path)).collect()) == want


def test_merkle_split_groups_and_other_fanout(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs = docs.withColumn("leaf", merkle.leaf(*[F.col(f) for f in FIELDS]))
    whole = merkle.manifest(docs, "doc_id", "lang").collect()
    split = merkle.manifest(docs, "doc_id", "lang", max_rows=16).collect()
    assert in_order(r[:4] for r in whole) == in_order(r[:4] for r in split)
    for fanout in (2, 3):
        made = merkle.manifest(docs, "doc_id", "lang", fanout=fanout)
        assert made.where(merkle.fold(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    assert merkle.manifest(docs.where("false"), "doc_id", "lang").count() == 0
