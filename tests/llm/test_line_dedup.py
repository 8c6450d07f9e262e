import random
import re

import duckdb
from pyspark.sql import functions as F

from tests.llm.conftest import EDGE, SF, docs
from txsentry.llm import line_dedup as ld


def hashes(spark, tokens):
    """Spark's hash of each token, which decides where long stretches are cut."""
    return {r.t: r.h for r in spark.createDataFrame([(t,) for t in tokens], "t string").select("t", F.xxhash64("t").alias("h")).collect()}


def spaced(t):
    if re.search(ld.BLANKS, t):
        t = re.sub(r"[ \t\r\x0b\f]+", " ", t)
    t = re.sub(ld.QUOTED, "\\1\x0b", t)
    for e in ".!?…。！？":
        t = t.replace(e + " ", e + "\x0b")
    return re.sub(ld.CJK_STOP, "\\1\f\x0b", t)


def mask(t):
    return re.sub(r"(?<!\S)[^\s\d]*\d\S*", "<*>", t)


def brute(spark, rows, min_docs=2):
    """The same rule row by row: (text, dropped lines, dropped pieces) per row of distinct ids."""
    lines = {}  # (id, line) -> masked tokens in lists, one for each sentence

    def sentences(line):
        return [p.split(" ") for p in line.strip(" \x0b\f").split("\x0b")]

    for d, t in rows:
        for i, line in enumerate(mask(spaced(t)).split("\n")):
            if line.strip(" \x0b\f"):
                lines[d, i] = sentences(line)
    cuts = hashes(spark, {t for ss in lines.values() for ts in ss for t in ts})

    def cut(parts, shown=None):
        out = []
        for ts, ss in zip(parts, shown or parts):
            out.append([])
            h = [cuts[t] for t in ts]
            for i, s in enumerate(ss):
                out[-1].append(s)
                if len(ts) > ld.LONG_PIECE and h[i] == min(h[max(i - ld.REACH, 0) : i + ld.REACH + 1]):
                    out.append([])
            if not out[-1]:
                out.pop()
        return [" ".join(p) for p in out]

    pieces = {k: cut(ss) for k, ss in lines.items()}
    lines = {k: [t for ts in ss for t in ts] for k, ss in lines.items()}
    parted = {(d, i): [p.split(" ") for p in mask(spaced(t)).split("\n")[i].strip(" \x0b\f").split("\x0b")] for d, t in rows for i in range(len(t.split("\n"))) if (d, i) in lines}
    ids = {}
    for (d, i), ts in lines.items():
        for u in {" ".join(ts), *pieces[d, i]}:
            ids.setdefault(u, set()).add(d)

    def goes(u, d):
        return len(ids[u]) >= min_docs and d != min(ids[u])

    def runs(values):
        """Per element the total of its run of elements that are not None."""
        out, i = [None] * len(values), 0
        while i < len(values):
            j = i
            while j < len(values) and values[j] is not None:
                j += 1
            out[i:j] = [sum(values[i:j])] * (j - i)
            i = max(j, i + 1)
        return out

    last = max((i for _, i in lines), default=0) + 1
    full, inside = set(), {}
    for d in {d for d, _ in lines}:
        whole = [None] * last
        for i in range(last):
            if (d, i) in lines:
                n, ps = [len(p.split(" ")) for p in pieces[d, i]], pieces[d, i]
                away = [goes(p, d) for p in ps]
                if goes(" ".join(lines[d, i]), d) or all(away):
                    whole[i] = sum(n)
                total = runs([(k if k >= ld.SHORT_PIECE else 0) if x else None for k, x in zip(n, away)])
                inside[d, i] = [j for j, x in enumerate(total) if x is not None and x >= ld.MIN_SENTENCE_TOKENS and len(ps) > 1]
        full |= {(d, i) for i, x in enumerate(runs(whole)) if x is not None and x >= ld.MIN_LINE_TOKENS}
    # templates of the lines that are left
    left = {k: ts for k, ts in lines.items() if k not in full and len(ts) >= ld.MIN_CONSTANT}
    leaves = {}
    for k, ts in left.items():
        leaves.setdefault((len(ts), ts[0], ts[-1]), []).append(k)
    for (n, *_), ks in leaves.items():
        held = {}
        for d, i in ks:
            for at, t in enumerate(left[d, i]):
                held.setdefault((at, t), set()).add(d)
        same = {}
        for d, i in ks:
            form = tuple(t if len(held[at, t]) >= 2 else None for at, t in enumerate(left[d, i]))
            const = sum(t is not None for t in form)
            if const >= ld.CONSTANT * n and const >= ld.MIN_CONSTANT:
                same.setdefault(form, []).append((d, i))
        for members in same.values():
            docs_ = {d for d, _ in members}
            if len(docs_) >= min_docs:
                full |= {(d, i) for d, i in members if d != min(docs_)}
    out = {}
    for d, t in rows:
        kept, gone, lost = [], 0, 0
        for i, line in enumerate(t.split("\n")):
            if (d, i) in full:
                gone += 1
            elif inside.get((d, i)):
                left = [p for j, p in enumerate(cut(parted[d, i], sentences(spaced(line)))) if j not in inside[d, i]]
                kept.append(" ".join(left).replace("\f ", "").replace("\f", ""))
                lost += len(inside[d, i])
            else:
                kept.append(line)
        out[d] = ("\n".join(kept), gone, lost)
    return out


def test_against_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' where text is not null").fetchall()
    got = {r.doc_id: (r.text, r.dropped_lines, r.dropped_sentences) for r in ld.dedup_lines(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert {d: got[d] for d, _ in rows} == brute(spark, rows)


def test_passage_inside_lines_and_fields(spark):
    passage = "The first sentence of a shared passage has many words. The second one is as long as the first one was. And here a third one ends it all."
    rows = [(i, f"Own start {w} {passage} own end {w}.\nLog entry {i} at 10:0{i} of user{i} done now") for i, w in enumerate(["alpha", "beta", "gamma"])]
    got = {r.doc_id: r.text for r in ld.dedup_lines(docs(spark, rows)).collect()}
    assert passage in got[0] and "Log entry" in got[0]
    for i in (1, 2):
        assert "second one" not in got[i] and "Log entry" not in got[i] and "Own start" in got[i]


def test_clean_text_stays(spark):
    rows = [(1, "Yes. All different words stand here in this line.\nOk."), (2, "Yes. Nothing of that other text is found in mine.\nOk.")]
    got = {r.doc_id: (r.text, r.dropped_lines) for r in ld.dedup_lines(docs(spark, rows)).collect()}
    assert got == {d: (t, 0) for d, t in rows}


def test_three_documents_needed(spark):
    line = "a line that is found in a few documents of ours"
    rows = [(1, line), (2, line), (3, "b"), (3, line + " c")]
    assert [r.text for r in ld.dedup_lines(docs(spark, rows), min_docs=3).orderBy("doc_id").collect()][:2] == [line, line]
    got = ld.dedup_lines(docs(spark, [*rows, (4, line)]), min_docs=3).orderBy("doc_id").collect()
    assert [r.text for r in got if r.doc_id in (1, 2, 4)] == [line, "", ""]


def test_edge_rows(spark):
    df = docs(spark, EDGE, extra=True)
    got = ld.dedup_lines(df)
    assert got.columns == [*df.columns, "dropped_lines", "dropped_sentences"]
    rows = got.collect()
    assert len(rows) == len(EDGE)
    assert [r.text for r in rows if r.doc_id == 1] == [None]
    # rows of one id are one document, so nothing recurs here
    assert sorted(str(r.text) for r in rows) == sorted(str(e[1]) for e in EDGE)
    assert ld.dedup_lines(docs(spark, [])).count() == 0


def test_a_sentence_meets_an_equal_line(spark):
    line = "This whole line is pasted into another text as well."
    rows = [(1, line), (2, f"Own words stand here. {line} And here are more of them.")]
    got = {r.doc_id: (r.text, r.dropped_sentences) for r in ld.dedup_lines(docs(spark, rows)).collect()}
    assert got == {1: (line, 0), 2: ("Own words stand here. And here are more of them.", 1)}


def test_names_that_vary_share_a_template(spark):
    who = [("alice", "paris"), ("bob", "rome"), ("carol", "oslo"), ("dave", "bern")]
    rows = [(i, f"User {n} logged in from the {t} office today\nThe line of {n} about {t} stands alone here {'so ' * i}") for i, (n, t) in enumerate(who)]
    rows += [(9, "User of many words who went away with another office today")]
    got = {r.doc_id: (r.text, r.dropped_lines) for r in ld.dedup_lines(docs(spark, rows)).collect()}
    assert got == {d: v[:2] for d, v in brute(spark, rows).items()}
    assert "User alice" in got[0][0] and not any("logged in" in got[i][0] for i in (1, 2, 3)) and got[9] == (rows[-1][1], 0)


def test_passage_without_a_stop(spark):
    rng = random.Random(6)
    vocab = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ra", "si", "to", "ve") for c in ("n", "l", "x", "")]
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    rows = [(i, f"Own start {w} {'and more of it ' * i}{passage} own end {w} of this line") for i, w in enumerate(["alpha", "beta", "gamma"])]
    got = {r.doc_id: r.text for r in ld.dedup_lines(docs(spark, rows)).collect()}
    assert got[0] == rows[0][1]
    for i in (1, 2):
        left = got[i].split(" ")
        assert left[:2] == ["Own", "start"] and left[-2:] == ["this", "line"] and len(left) < 22 + 36
    assert got == {d: v[0] for d, v in brute(spark, rows).items()}


def test_quotes_brackets_and_cjk_stops(spark):
    said = "\"We saw it all ourselves on that same day.\" (Nobody else did say so at all!) That is where it ended for them."
    cjk = "今天天气很好。我们去公园！"
    rows = [(i, f"{w} {said} {w} went on\n{w}。{cjk}{w}") for i, w in enumerate(["alpha", "beta"])]
    got = {r.doc_id: r.text for r in ld.dedup_lines(docs(spark, rows), min_sentence_tokens=8).collect()}
    assert got == {d: v[0] for d, v in brute(spark, rows).items()}
    assert got[0] == rows[0][1] and "Nobody" not in got[1] and "beta went on" in got[1]


def test_ids_of_text_and_rows_without_id(spark):
    line = "a whole line that is found in a few documents of ours"
    df = spark.createDataFrame([("b", line), ("a", line + "\nown words"), (None, line), (None, line)], "doc_id string, text string")
    got = sorted((str(r.doc_id), r.text) for r in ld.dedup_lines(df).collect())
    assert got == [("None", ""), ("None", ""), ("a", line + "\nown words"), ("b", "")]


def test_long_line_and_many_lines(spark):
    """Linear work: a line of 100,000 words and a text of 20,000 lines, twice each."""
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(100_000))
    many = "\n".join(f"line {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)} of many" for i in range(17_000))
    got = {r.doc_id: r.text for r in ld.dedup_lines(docs(spark, [(1, "x " + long), (2, "y " + long), (3, many), (4, many + "\nits own end")])).collect()}
    assert got[1] == "x " + long and got[3] == many
    assert len(got[2]) < 400 and got[4] == "its own end"


def test_parsing_takes_each_text_step_once(spark):
    """Texts are the bulk of the work: the plan replaces and splits no text twice over."""
    plan = ld.parsed_units(docs(spark, [(1, "a line. of two")]))._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"(?<!_)replace\(", plan)) <= 13 and len(re.findall(r"\bsplit\(", plan)) <= 6


def test_rows_that_come_twice(spark):
    shared = "It was seen by all of them on that very same day. Nobody has ever said so before or after."
    rows = [(i, f"{w} began here. {shared} {w} went on\n{w} alone") for i, w in enumerate(["alpha", "beta"])]
    got = sorted((r.doc_id, r.text, r.dropped_sentences) for r in ld.dedup_lines(docs(spark, rows + rows)).collect())
    once = sorted((r.doc_id, r.text, r.dropped_sentences) for r in ld.dedup_lines(docs(spark, rows)).collect())
    assert got == sorted(once + once) and got[2][2] > 0


def test_lines_carry_no_text(spark):
    """A row's numbers are taken once, not once per line together with its whole text."""
    plan = ld.parsed_units(docs(spark, [(1, "a line. of two\nand another")]))._jdf.queryExecution().executedPlan().toString()
    carried = re.findall(r"Generate posexplode\(.*\), \[([^\[\]]*)\], false, \[line", plan, re.S)
    assert len(carried) == 1 and "text#" not in carried[0]


def test_units_meet_their_keys_unsorted(spark):
    units = spark.range(100).select(F.col("id"), (F.col("id") % 50).alias("key"))
    plan = ld.with_first(units, ld.recurring(units), 100)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan


def test_tokens_of_lines_with_rare_signs(spark):
    """White space, fields and stops of CJK text: templates by the same tokens as the pieces."""
    lines = [f"  User {w}\tof  room{i} saw this：没有。好的 (all of it) and then left \f" for i, w in enumerate(["alice", "bob", "carol"])]
    rows = [(i, t + "\nown words of " + str(i)) for i, t in enumerate(lines)]
    got = {r.doc_id: (r.text, r.dropped_lines) for r in ld.dedup_lines(docs(spark, rows)).collect()}
    assert got == {d: v[:2] for d, v in brute(spark, rows).items()} and got[1][1] > 0


def test_texts_without_rare_signs_meet_few_patterns(spark):
    """A pattern passes over a text many times slower than a search for bytes: parsing plain text tries one, the digit's."""
    plan = ld.parsed_units(docs(spark, [(1, "a line. of two")]))._jdf.queryExecution().optimizedPlan().toString()
    # every other pattern stands behind a search for bytes: white space, a closing sign before a space, signs beyond ASCII
    assert "RLIKE(text" in plan and "Contains(" in plan and "octet_length(" in plan
    assert not re.search(r"WHEN \(*RLIKE\(lambda x_\d+#\d+, \[", plan)


def test_signs_that_ask_for_patterns(spark):
    """Each kind of sign that a text may need more than its ASCII stops marked for, alone in its texts."""
    signs = ["\t", "\r", "\x0b", "\f", "  ", '." ', "!' ", "?) ", ".] ", ".” ", "!」 ", "?）", "… ", "。", "！", "？", "。」", "é. ", "don't. ", " 7 ", "7\t8"]
    rows = []
    for k, s in enumerate(signs):
        passage = f"All of them saw number{'x' * k} on that day{s}Nobody has ever said so before or after it was found."
        rows += [(10 * k + i, f"{w} began here. {passage} {w} went on\n{w} alone") for i, w in enumerate([f"alpha{chr(97 + k)}", f"beta{chr(97 + k)}"])]
    got = {r.doc_id: (r.text, r.dropped_lines, r.dropped_sentences) for r in ld.dedup_lines(docs(spark, rows)).collect()}
    assert got == brute(spark, rows)
    assert all(got[10 * k + 1][2] > 0 for k in range(len(signs)))


def test_cut_lines_take_their_tokens_once(spark):
    """Linear work where pieces go from a line: its tokens are split once, not once per token."""
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(17_000))
    got = {r.doc_id: r.text for r in ld.dedup_lines(docs(spark, [(1, "own start x " + long), (2, "another start y of it " + long + " end z")])).collect()}
    assert got[1] == "own start x " + long and got[2].startswith("another start") and len(got[2]) < 200
