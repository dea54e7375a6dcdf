"""Mixing, tokenizer alignment and conversation repair against SQL and plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import duckdb
import pytest

import public_tokenizers
from tidelake.llm import four_russians as fr
from tidelake.llm import op11_mixing, op12_alignment, op13_repair

SF = "/root/testdata/sf0.001"
BPE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def parquet(name, columns):
    return duckdb.sql(f"select {columns} from read_parquet('{SF}/{name}.parquet')").fetchall()


# --- mixing ---------------------------------------------------------------------------------------

MIX = "doc_id long, text string, source string, size string, target int, _row int"


def mix_rows():
    r = random.Random(4)
    rows = [(i, "w " * r.randint(0, 60), r.choice(["hot", "hot", "b", "é", "", None]), "x", 1, 2) for i in range(600)]
    rows += [(None, None, "zero", "x", 1, 2)] * 3 + [(7, "same words", "b", "x", 1, 2)] * 5
    rows += [(8, " \t\n", None, None, None, None), (9, "long " * 40_000, "hot", "x", 1, 2)]
    return rows


def test_mixing_equals_sql_with_odd_rows(spark):
    docs = spark.createDataFrame(mix_rows(), MIX).repartition(7)
    rows = docs.select("doc_id", "source", op11_mixing.n_words(docs.text).alias("size"))
    got = tuples(op11_mixing.expected(rows).selectExpr("doc_id", "size", "source_size", "target", "copies * size", "source", "copies"))
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [r[:3] for r in mix_rows()])
    assert got == sorted(con.execute(op11_mixing.oracle()).fetchall(), key=str)


def filled(sizes, weights, share, most):
    """Targets by sharing again what is over, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, rest, free = dict.fromkeys(order, 0.0), share * sum(sizes.values()), set(order)
    while rest > 1e-9 and free:
        unit = rest / sum(weight[s] for s in free)
        for s in free:
            target[s] += weight[s] * unit
        rest = 0.0
        for s in list(free):
            if target[s] >= most * sizes[s]:
                rest += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                free.discard(s)
    return target


def test_mixing_targets_and_copies(spark):
    docs = spark.createDataFrame(mix_rows(), MIX).repartition(7)
    rows = docs.select("doc_id", "source", op11_mixing.n_words(docs.text).alias("size"))
    out = op11_mixing.expected(rows).collect()
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        longest[r.source] = max(longest[r.source], r.size)
        assert 0 <= r.copies <= 2
    goal = filled(sizes, op11_mixing.WEIGHTS, op11_mixing.SHARE, op11_mixing.MOST)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
    for s, words in taken.items():
        assert abs(words - goal[s]) <= 1.5 * longest[s]
    other = op11_mixing.expected(rows, weights=(1,), share=0.5, most=1.0).collect()
    assert {r.copies for r in other} <= {0, 1}
    assert sum({r.source: r.target for r in other}.values()) == pytest.approx(sum(sizes.values()) / 2)


def test_mix_emits_whole_rows(spark):
    docs = spark.createDataFrame(mix_rows(), MIX).repartition(3)
    rows = docs.select("doc_id", "source", op11_mixing.n_words(docs.text).alias("size"))
    copies = Counter()
    for r in op11_mixing.expected(rows).collect():
        copies[r.doc_id, r.source] += r.copies
    mixed = op11_mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = [tuple(r) for r in mixed.collect()]
    assert set(got) <= set(mix_rows())
    assert Counter((r[0], r[2]) for r in got) == +copies
    assert sorted(got, key=str) == tuples(op11_mixing.mix(docs.repartition(5)))  # reruns agree
    assert op11_mixing.mix(docs.limit(0)).collect() == []


def test_mixing_stays_in_the_jvm(spark):
    df = op11_mixing.op11_mixing(spark, SF)
    assert len(df.collect()) == 200
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))


# --- alignment ------------------------------------------------------------------------------------

def align_plainly(rows):
    """Ends by dictionaries, one document after the other."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    letter = op12_alignment.byte_letters()
    out, count = [], Counter()
    for doc, text in rows:
        whole = (" " + (text or "")).encode()
        a = tok.encode(" " + (text or ""), add_special_tokens=False)
        a = list(zip(a.ids, (bytes(letter[c] for c in t) for t in a.tokens)))
        b = [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
             for i in sp.encode(text or "")]
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            out.append((doc, 0, 0, 0, [], ""))
            continue
        ends = []
        for side in (a, b):
            at, end = 0, {}
            for i, x in side:
                at += len(x)
                end[at] = i
            ends.append(end)
        cuts = sorted(ends[0].keys() & ends[1].keys())
        links = [(ends[0][c], ends[1][c]) for c in cuts]
        count.update(links)
        groups = ["|".join(",".join(str(e[k]) for k in sorted(e) if lo < k <= hi) for e in ends) for lo, hi in zip([0, *cuts], cuts)]
        out.append((doc, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return sorted(((d, na, nb, g, len(x), sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x), h)
                   for d, na, nb, g, x, h in out), key=str)


def test_alignment_equals_plain_python(spark):
    assert tuples(op12_alignment.op12_alignment(spark, SF)) == align_plainly(parquet("documents", "doc_id, text"))


@pytest.mark.parametrize("block", [60, 1 << 22])
def test_alignment_of_odd_rows_in_small_and_large_blocks(spark, block):
    r = random.Random(8)
    bits = ["a", "ba", " ", "  ", "\n", "é", "漢字", "😀", "▁", ".", "'s", "\t", "the ", "\x00", "<|endoftext|>", "</s>", "　", "İ"]
    rows = [(i, "".join(r.choice(bits) for _ in range(r.randint(0, 12)))) for i in range(150)]
    rows += [(None, "no id"), (5, None), (6, ""), (7, "twice the same"), (7, "twice the same"), (8, "x" * 70_000 + " word" * 9000)]
    docs = spark.createDataFrame([(*x, "c", 3) for x in rows], "doc_id long, text string, pairs string, block int").repartition(3)
    assert tuples(op12_alignment.align(docs, BPE, PIECE, block)) == align_plainly(rows)
    assert op12_alignment.align(docs.limit(0), BPE, PIECE, block).collect() == []


# --- conversation repair --------------------------------------------------------------------------

def cheapest(codes):
    """Least (price, letters) by comparing all ways from each row and state on."""
    symbols = [int(fr.SYMBOL[c]) for c in codes]

    @lru_cache(None)
    def best(i, state, inserted):
        ways = [(0, "")] if i == len(symbols) and state in (fr.START, fr.ASSISTANT) else []
        if inserted < 3:
            price, rest = best(i, fr.NEXT[state], inserted + 1)
            ways.append((3 + price, "I" + rest))
        if i < len(symbols):
            for letter, price, to, _ in fr.options(state, symbols[i]):
                more, rest = best(i + 1, to, 0)
                ways.append((price + more, letter + rest))
        return min(ways, default=(10 ** 9, ""))

    return best(0, fr.START, 0)


@pytest.mark.parametrize("length", [1, 3, 4])
def test_block_tables_give_the_least_cheapest_audit(length, monkeypatch):
    tables = fr.Tables(length)
    monkeypatch.setattr(fr, "_tables", [tables])
    r = random.Random(length)
    for _ in range(1500):
        codes = [r.randrange(12) for _ in range(r.randint(0, 14))]
        cuts = sorted(r.randint(0, len(codes)) for _ in range(r.randint(0, 4)))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        effects = [fr.summary(op13_repair.plain(p)) for p in parts]
        half = len(parts) // 2
        groups = [g for g in (effects[:half], effects[half:]) if g]
        around = [w for g, (v, s) in zip(groups, fr.within([fr.compose(g) for g in groups], 0, fr.START)) for w in fr.within(g, v, s)]
        audit, price = "", 0
        for i, (p, (last, entry)) in enumerate(zip(parts, around)):
            if p:
                found = op13_repair.edit(p, 0, last, entry, False)
                audit, price = audit + found[0], price + found[5]
        state = fr.START
        for p, (last, entry) in zip(parts, around):
            state = int(fr.summary(op13_repair.plain(p))[1][last, entry])
        extra = tables.finish(state)
        assert (price + 3 * len(extra), audit + "I" * len(extra)) == cheapest(tuple(codes))


def repair_plainly(rows):
    conversations, out = defaultdict(list), []
    for conv, turn, role, text in rows:
        said = conversations[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        said += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for conv, said in conversations.items():
        said = sorted(said, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).digest()))
        turns = [t for t, _, _ in said if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, seen, codes = [], set(), []
        for _, role, text in said:
            words = re.findall("[^\x20\x09-\x0D]", text)
            faults.append("blank" if not words else "duplicate" if (role, text) in seen else "cut" if words[-1] not in ".!?" else "")
            seen.add((role, text))
            codes.append("sua".find(role[:1] or "-") % 4 * 3 + {"": 0, "cut": 1}.get(faults[-1], 2))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        cost, audit = walk(codes)
        lines, i, last = [], 0, ""
        for letter in audit:
            if letter in "RI":
                last = "user" if last[:1] != "u" else "assistant"
            elif letter == "K":
                last = said[i][1]
            if letter != "D":
                lines.append(last + ":" + ("" if letter == "I" else said[i][2]))
            i += letter != "I"
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines))
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("cut"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def walk(codes):
    """``cheapest`` without recursion, for long conversations: prices backward, letters forward."""
    symbols = [int(fr.SYMBOL[c]) for c in codes]
    costs = [list(fr.ACCEPT)]
    for s in reversed(symbols):
        costs.append(fr.row_costs(costs[-1], s))
    costs.reverse()
    state, i, audit = fr.START, 0, ""
    while i < len(symbols) or state not in (fr.START, fr.ASSISTANT):
        ways = [("I", fr.NEXT[state], 0)] if 3 + costs[i][fr.NEXT[state]] == costs[i][state] else []
        if i < len(symbols):
            ways += [(letter, to, 1) for letter, p, to, _ in fr.options(state, symbols[i]) if p + costs[i + 1][to] == costs[i][state]]
        letter, state, step = min(ways)
        audit, i = audit + letter, i + step
    return costs[0][fr.START], audit


def test_repair_equals_plain_python(spark):
    assert tuples(op13_repair.op13_repair(spark, SF)) == repair_plainly(parquet("conversations", "conv_id, turn, role, text"))


def conversations():
    r = random.Random(3)
    texts = ["Hi.", "Ok", None, "", "x y?", " \t", "a" * 5000 + "!", "…", " . "]
    rows = [(c, r.choice([None, r.randint(0, 40), r.randint(0, 900)]), r.choice(["user", "assistant", "system", None, "tool", "", "usher"]),
             r.choice([*texts, str(r.random()), f"{r.random()}."])) for c in (1, None, *[9] * 4) for _ in range(120)]
    rows += [(100 + c, t, r.choice(["system", "user"]), "Only.") for c in range(40) for t in range(r.randint(1, 4))]
    return rows + rows[:30]


@pytest.mark.parametrize("rows_log2, size, fan", [(12, 8 << 20, 256), (3, 8 << 20, 3), (12, 6000, 2)])
def test_repair_of_long_and_odd_conversations(spark, monkeypatch, rows_log2, size, fan):
    monkeypatch.setattr(op13_repair, "ROWS_LOG2", rows_log2)
    monkeypatch.setattr(op13_repair, "BYTES", size)
    df = spark.createDataFrame([(*x, "c", 1) for x in conversations()],
                               "conv_id long, turn long, role string, text string, seg string, place int").repartition(5)
    rows = op13_repair.keyed(df)
    fixed = op13_repair.repair(op13_repair.damage(rows).select("conv", "turn", "role", "text"), fan)
    assert tuples(op13_repair.report(rows, fixed)) == repair_plainly(conversations())


def test_repair_of_nothing(spark):
    rows = op13_repair.keyed(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert op13_repair.report(rows, op13_repair.repair(op13_repair.damage(rows).select("conv", "turn", "role", "text"))).collect() == []
