import json
import random
import re

from pyspark.sql import functions as F

from replyscope.config import DEFAULT_RUBRIC
from replyscope.functions.judge import parse_judge_reply, signals
from replyscope.functions.prompt import GENERIC_REPLY, PROMPT_HEADER, grounded_reply, \
    grounded_reply_from_prompt, user_prompt
from replyscope.plans.generate import prompts
from replyscope.plans.queries import ODD_REPLIES


def _parse(spark, text):
    df = spark.createDataFrame([(text,)], "r string")
    p = parse_judge_reply(F.col("r"))
    return df.select(p["ok"].alias("ok"), *[p[d].alias(d) for d in DEFAULT_RUBRIC],
                     p["rationale"].alias("rationale")).first()


def test_parse_scores(spark):
    r = _parse(spark, 'x {"correctness": 9, "tone": "4", "empathy": null} y')
    assert r.ok and (r.correctness, r.tone, r.empathy) == (5, 4, 3)
    assert (r.professionalism, r.completeness, r.grammar, r.actionability) == (3, 3, 3, 3)


def test_parse_no_braces_and_broken(spark):
    r = _parse(spark, "no json here")
    assert r.ok and r.correctness == 3 and r.rationale == ""
    open_only = _parse(spark, '{"correctness": 4, ')   # no closing brace -> no span
    assert open_only.ok and open_only.correctness == 3
    assert not _parse(spark, '{"correctness": }').ok


def test_parse_non_finite_falls_back(spark):
    assert _parse(spark, '{"correctness": NaN, "tone": 4}')[:2] == (True, 3)
    assert not _parse(spark, '{"correctness": Infinity}').ok
    assert not _parse(spark, '{"correctness": "inf"}').ok
    assert not _parse(spark, '{"tone": "-Infinity", "correctness": 4}').ok


def test_signals_substring_rules(spark):
    df = spark.createDataFrame([("His order is here", "x"), ("this is essential", "y?")], "c string, e string")
    s = signals(F.col("e"), F.col("c"))
    rows = df.select(s["greeting"].alias("g"), s["action"].alias("a"), s["addresses_q"].alias("q")).collect()
    assert rows[0].g is True
    assert rows[1].a is True and rows[1].q is True


def test_prompt_without_cases(spark):
    q = spark.createDataFrame([(1, "Where is my order?")], "query_id long, query_email string")
    cases = spark.createDataFrame([], "query_id long, rank int, id long, score double, customer_email string, support_reply string, category string")
    r = prompts(q, cases).first()
    assert r.user_prompt == (PROMPT_HEADER + "\n" + "\nNow write the best reply to this NEW customer email:\n"
                             "Customer: Where is my order?\nAgent reply:")
    df = spark.createDataFrame([(r.user_prompt, r.top_reply)], "p string, t string")
    out = df.select(grounded_reply(F.col("t")), grounded_reply_from_prompt(F.col("p"))).first()
    assert out[0] == GENERIC_REPLY and out[1] == GENERIC_REPLY


def test_grounded_reply_from_prompt(spark):
    df = spark.createDataFrame([("a <<TOP_REPLY>>  Hi there.\n<<END_TOP_REPLY>> b",)], "p string")
    out = df.select(grounded_reply_from_prompt(F.col("p"))).first()[0]
    assert out.endswith("happy to help. Hi there.")


REPLIES = [
    *(text for text, *_ in ODD_REPLIES), "", "none", "{", "} {", "x {} y",
    '{"tone": 0.5, "empathy": 1.5, "grammar": 2.5, "correctness": 3.5, "completeness": 4.5}',
    '{"tone": -0, "empathy": 6, "grammar": 007}', '{"tone": 1e400}', '{"tone": 1e2}',
    '{"tone": "1e2", "empathy": "+4", "grammar": ".5", "correctness": "5.", "completeness": ""}',
    '{"tone": 123456789012345678901234567890}', '{"tone": "0x5"}', '{"tone": "\u0664"}',
    '{"tone": false, "rationale": false}', '{"rationale": {"a": 1.0, "b": "it\'s"}}',
    '{"rationale": 12345678901234567890}', '{"rationale": "' + "long \\n é " * 300 + '"}',
    '{"rationale": "a", "rationale": null}', '{"tone": {"x": 1}}', '{"tone": 4,}',
    '{"tone": 4} trailing }', '[{"tone": 4}]', '{"tone"\n:\t4 ,"\\u0074one": 2}',
    '{"tone": "4", "rationale": "line\nbreak"}', '{"a": ' + "[" * 3000 + "]" * 3000 + "}",
    '{"tone": "Infinity"}', '{"tone": "nan", "rationale": "\\ud83d\\ude00 \\ud83d"}',
    '{"tone": 4, "rationale": ""}', '{"tone": "1_000"}', '{"tone": 2.4999999999999999999}',
]


def read_by_hand(reply):
    """The same rules as plain Python, from the whole reply."""
    found = re.search(r"\{.*\}", reply, re.DOTALL)
    try:
        raw = json.loads(found.group(0)) if found else {}
        out = []
        for name in DEFAULT_RUBRIC:
            try:
                out.append(max(1, min(5, int(round(float(raw.get(name, 3)))))))
            except (TypeError, ValueError):
                out.append(3)
        text = str(raw.get("rationale", ""))[:400]
        return True, out, text.encode("utf-8", "replace").decode()
    except Exception:
        return False, [3] * len(DEFAULT_RUBRIC), ""


def test_replies_are_read_as_python_reads_them(spark):
    rng = random.Random(3)
    values = ["4", "2.5", "-1", '"3"', '"x"', "null", "true", "NaN", "1e1", "[1]", '"4_0"', "0.50"]
    made = []
    for _ in range(300):
        fields = [f'"{rng.choice(DEFAULT_RUBRIC + ("rationale",))}": {rng.choice(values)}'
                  for _ in range(rng.randint(0, 5))]
        made.append(rng.choice(["", "Verdict: "]) + "{" + ", ".join(fields) + rng.choice(["}", "} .", ",}"]))
    replies = REPLIES + made
    df = spark.createDataFrame(list(enumerate(replies)), "i int, r string").repartition(3)
    p = parse_judge_reply(F.col("r"))
    rows = df.select("i", p["ok"].alias("ok"), F.array(*[p[d] for d in DEFAULT_RUBRIC]).alias("s"),
                     p["rationale"].alias("why")).collect()
    assert len(rows) == len(replies)
    for r in rows:
        assert (r.ok, r.s, r.why) == read_by_hand(replies[r.i]), replies[r.i][:200]
    for i, (_, ok, score, why) in enumerate(ODD_REPLIES):
        got = next(r for r in rows if r.i == i)
        assert (got.ok, got.s[0], got.why) == (ok, score, why)
