"""DuckDB oracle SQL for the registered queries.

Each query is restated from the raw tables in plain SQL (CTEs), independent
of the Spark plan, so the driver can compare results."""
from __future__ import annotations

from ..config import DEFAULT_RUBRIC, Weights
from ..functions.judge import (ACTION_MARKERS, CLOSING_MARKERS, EMPATHY_MARKERS,
                               GREETING_PREFIXES, JUDGE_INTRO, JUDGE_OUTRO, NEUTRAL,
                               RATIONALE_MAX, SENTENCE_ENDINGS)
from ..functions.prompt import (GENERIC_REPLY, GROUNDED_PREFIX, PROMPT_HEADER, PROMPT_TAIL,
                                PROMPT_TASK, TOP_CLOSE, TOP_OPEN)
from ..functions.text import ENGLISH_STOP_WORDS, TERM_PATTERN, WORD_PATTERN
from ..sources.reports import CATEGORY_WIDTH, RULE_WIDTH, SUMMARY_TITLE
from ..sources.tickets import (CITIES, DAYS_RANGE, NAMES, ORDER_ID_RANGE, PRODUCTS,
                               template_rows)
from .queries import ODD_EVERY, ODD_REPLIES

SEED, K, MAX_FEATURES, PER_CATEGORY, HOLDOUT, LIMIT = 42, 3, 4096, 2, 20, 7
W = Weights()
RUBRIC = DEFAULT_RUBRIC
NL = "chr(10)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


STOP = lst(ENGLISH_STOP_WORDS)


def rnd(x: str, d: int = 6) -> str:
    scale = repr(float(10 ** d))
    return f"(round_even(({x}) * {scale}, 0) / {scale})"


def mean(x: str, d: int) -> str:
    """The mean of six-place numbers, rounded half-even in whole numbers."""
    total = f"sum(CAST(round_even(({x}) * 1000000.0, 0) AS HUGEINT))"
    parts = f"(count({x}) * {10 ** (6 - d)})"
    rest = f"((({total} % {parts}) + {parts}) % {parts})"
    floor = f"(({total} - {rest}) // {parts})"
    up = f"2 * {rest} > {parts} OR (2 * {rest} = {parts} AND {floor} % 2 <> 0)"
    return (f"(CASE WHEN count({x}) > 0 THEN ({floor} + CASE WHEN {up} THEN 1 ELSE 0 END)::DOUBLE "
            f"/ {float(10 ** d)!r} END)")


def middle(x: str, d: int) -> str:
    whole = f"median(CAST(round_even(({x}) * 1000000.0, 0) AS BIGINT))"
    return f"(round_even({whole} / {float(10 ** (6 - d))!r}, 0) / {float(10 ** d)!r})"


def uni(t: str) -> str:
    return (f"list_filter(regexp_extract_all(lower(coalesce({t}, '')), {lit(TERM_PATTERN)}), "
            f"lambda x: NOT list_contains({STOP}, x))")


def words(t: str) -> str:
    return f"regexp_extract_all(lower(coalesce({t}, '')), {lit(WORD_PATTERN)})"


def strip(t: str) -> str:
    space = ("[\\t\\n\\x0B\\f\\r\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}"
             "\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+")
    return f"regexp_replace(coalesce({t}, ''), '^{space}|{space}$', '', 'g')"


def with_bigrams(u: str) -> str:
    return f"list_concat({u}, list_transform(range(1, len({u})), lambda i: {u}[i] || ' ' || {u}[i + 1]))"


def band(x: str) -> str:
    return f"CAST(least(greatest(round_even(1.0 + 4.0 * ({x}), 0), 1.0), 5.0) AS INTEGER)"


def sql(ctes: list[str], body: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(ctes) + "\n" + body


# ------------------------------------------------------------ fragments
PAIRS = """pairs AS (
  SELECT (u.conv_id << 20) + u.turn AS id, u.text AS customer_email, a.text AS support_reply,
         'c' || CAST(u.conv_id % 10 AS VARCHAR) AS category, u.conv_id, u.turn
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

EVAL_PAIRS = """eval_pairs AS (
  SELECT p.id, p.category, p.customer_email, coalesce(b.text, '') AS generated,
         p.support_reply AS reference
  FROM pairs p LEFT JOIN conversations b
    ON b.conv_id = p.conv_id AND b.turn = p.turn - 1 AND b.role = 'assistant')"""


def _draw(slot: str) -> str:
    return f"('0x' || substr(md5('{SEED}|' || CAST(doc_id AS VARCHAR) || '|{slot}'), 1, 8))::BIGINT"


def tickets_ctes() -> list[str]:
    rows = ",\n    ".join(
        f"({c}, {lit(name)}, {v}, {lit(e)}, {lit(r)})" for c, name, v, e, r in template_rows())
    lo, hi = ORDER_ID_RANGE
    dlo, dhi = DAYS_RANGE

    def pick(values, slot):
        return f"{lst(values)}[CAST({_draw(slot)} % {len(values)} AS INTEGER) + 1]"

    fill = lambda t: ("replace(replace(replace(replace(replace(" + t +  # noqa: E731
                      ", '{oid}', s.oid), '{p}', s.p), '{city}', s.city), '{name}', s.name), "
                      "'{days}', s.days)")
    return [
        f"tpl(category_no, category, variant, email_t, reply_t) AS (VALUES\n    {rows})",
        f"""slots AS (
  SELECT doc_id AS id, CAST(doc_id % 10 AS INTEGER) AS category_no,
         CAST((doc_id // 10) % 2 AS INTEGER) AS variant,
         '#' || CAST({_draw('oid')} % {hi - lo + 1} + {lo} AS VARCHAR) AS oid,
         {pick(PRODUCTS, 'p')} AS p, {pick(CITIES, 'city')} AS city, {pick(NAMES, 'name')} AS name,
         CAST({_draw('days')} % {dhi - dlo + 1} + {dlo} AS VARCHAR) AS days
  FROM documents)""",
        f"""tickets AS (
  SELECT s.id, {fill('t.email_t')} AS customer_email, {fill('t.reply_t')} AS support_reply,
         t.category
  FROM slots s JOIN tpl t USING (category_no, variant))""",
    ]


GIVEN = [PAIRS, "tickets AS (SELECT id, customer_email, support_reply, category FROM pairs)"]

SPLIT = [
    f"""ho_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY category
           ORDER BY md5('{SEED}|' || CAST(id AS VARCHAR)), id) AS holdout_rank
  FROM tickets)""",
    f"""holdout AS (SELECT * FROM ho_ranked WHERE holdout_rank <= {PER_CATEGORY}
  ORDER BY category, holdout_rank, id LIMIT {HOLDOUT})""",
    "kb AS (SELECT t.* FROM tickets t WHERE t.id NOT IN (SELECT id FROM holdout))",
    """kb_corpus AS (SELECT id AS doc_id, 'email' AS side, customer_email AS text FROM kb
  UNION ALL SELECT id AS doc_id, 'reply' AS side, support_reply AS text FROM kb)""",
]


def vocab_ctes(name: str, src: str, key: str, text: str) -> list[str]:
    return [
        f"{name}_u AS (SELECT {key} AS doc, {uni(text)} AS u FROM {src})",
        f"{name}_t AS (SELECT doc, {with_bigrams('u')} AS terms FROM {name}_u)",
        f"""{name}_s AS (SELECT term, count(*) AS tf, count(DISTINCT doc) AS df
  FROM (SELECT doc, unnest(terms) AS term FROM {name}_t) GROUP BY term)""",
        f"{name}_n AS (SELECT count(*) AS n FROM {src})",
        f"""{name} AS (SELECT v.term, v.tf, v.df, ln((1.0 + c.n) / (1.0 + v.df)) + 1.0 AS idf
  FROM (SELECT * FROM {name}_s ORDER BY tf DESC, term ASC LIMIT {MAX_FEATURES}) v, {name}_n c)""",
    ]


def vector_ctes(name: str, src: str, keys: list[str], text: str, vocab: str) -> list[str]:
    k = ", ".join(keys)
    return [
        f"{name}_u AS (SELECT {k}, {uni(text)} AS u FROM {src})",
        f"{name}_t AS (SELECT {k}, {with_bigrams('u')} AS terms FROM {name}_u)",
        f"""{name}_c AS (SELECT {k}, term, count(*) AS cnt
  FROM (SELECT {k}, unnest(terms) AS term FROM {name}_t) GROUP BY ALL)""",
        f"""{name} AS (SELECT {k}, term,
  cnt * idf / sqrt(sum((cnt * idf) * (cnt * idf)) OVER (PARTITION BY {k})) AS w
  FROM {name}_c JOIN {vocab} USING (term))""",
    ]


def topk_ctes(name: str, qv: str, dv: str, queries: str, kb: str, exclude: bool) -> list[str]:
    cond = "AND q.query_id <> d.id" if exclude else ""
    pcond = "WHERE q.query_id <> p.id" if exclude else ""
    return [
        f"""{name}_hits AS (SELECT q.query_id, d.id, q.w * d.w AS p
  FROM {qv} q JOIN {dv} d ON q.term = d.term {cond})""",
        f"""{name}_pad AS (SELECT q.query_id, p.id, 0.0 AS p
  FROM {queries} q, (SELECT id FROM {kb} ORDER BY id LIMIT {K + 1}) p {pcond})""",
        f"""{name}_cand AS (SELECT query_id, id, sum(p) AS score
  FROM (SELECT * FROM {name}_hits UNION ALL SELECT * FROM {name}_pad) GROUP BY ALL)""",
        f"""{name} AS (SELECT query_id, id, score,
  row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank
  FROM {name}_cand QUALIFY rank <= {K})""",
    ]


def cosine_ctes(name: str, ev: str, vocab: str) -> list[str]:
    """M1 over ``ev(id, generated, reference)``: ``{name}(pair_id, cosine)``."""
    return [
        f"""{name}_x AS (SELECT id AS pair_id, 'g' AS side, generated AS text FROM {ev}
  UNION ALL SELECT id AS pair_id, 'r' AS side, reference AS text FROM {ev})""",
        *vector_ctes(f"{name}_v", f"{name}_x", ["pair_id", "side"], "text", vocab),
        f"""{name} AS (SELECT e.id AS pair_id,
  least(greatest(coalesce(d.dot, 0.0), 0.0), 1.0) AS cosine
  FROM {ev} e LEFT JOIN (
    SELECT g.pair_id, sum(g.w * r.w) AS dot FROM {name}_v g JOIN {name}_v r
      ON g.pair_id = r.pair_id AND g.term = r.term AND g.side = 'g' AND r.side = 'r'
    GROUP BY g.pair_id) d ON d.pair_id = e.id)""",
    ]


def alignment_ctes(name: str, ev: str, vocab: str) -> list[str]:
    """M2 over ``ev``: ``{name}(pair_id, precision, recall, f1)``."""
    return [
        f"""{name}_x AS (SELECT id AS pair_id, 'g' AS side, generated AS text FROM {ev}
  UNION ALL SELECT id AS pair_id, 'r' AS side, reference AS text FROM {ev})""",
        f"""{name}_w AS (SELECT pair_id, side, word, count(*) AS cnt FROM (
  SELECT pair_id, side, unnest(CASE WHEN len(t) = 0 THEN [' '] ELSE t END) AS word
  FROM (SELECT pair_id, side, {words('text')} AS t FROM {name}_x)) GROUP BY ALL)""",
        f"{name}_dw AS (SELECT DISTINCT word FROM {name}_w)",
        *vector_ctes(f"{name}_wv", f"{name}_dw", ["word"], "word", vocab),
        f"""{name}_j AS (SELECT w.pair_id, w.side, w.word, v.term, v.w
  FROM {name}_w w JOIN {name}_wv v USING (word))""",
        f"""{name}_sim AS (SELECT g.pair_id, g.word AS gw, r.word AS rw, sum(g.w * r.w) AS sim
  FROM {name}_j g JOIN {name}_j r ON g.pair_id = r.pair_id AND g.term = r.term
  WHERE g.side = 'g' AND r.side = 'r' GROUP BY ALL)""",
        f"""{name}_best AS (
  SELECT pair_id, 'g' AS side, gw AS word, max(sim) AS best FROM {name}_sim GROUP BY ALL
  UNION ALL SELECT pair_id, 'r' AS side, rw AS word, max(sim) AS best FROM {name}_sim GROUP BY ALL)""",
        f"""{name}_pr AS (SELECT w.pair_id,
  greatest(sum(CASE WHEN w.side = 'g' THEN w.cnt * coalesce(b.best, 0.0) END)
           / sum(CASE WHEN w.side = 'g' THEN w.cnt END), 0.0) AS p,
  greatest(sum(CASE WHEN w.side = 'r' THEN w.cnt * coalesce(b.best, 0.0) END)
           / sum(CASE WHEN w.side = 'r' THEN w.cnt END), 0.0) AS r
  FROM {name}_w w LEFT JOIN {name}_best b
    ON b.pair_id = w.pair_id AND b.side = w.side AND b.word = w.word
  GROUP BY w.pair_id)""",
        f"""{name} AS (SELECT pair_id, p AS precision, r AS recall,
  greatest(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 0.0) AS f1 FROM {name}_pr)""",
    ]


def lcs_ctes(name: str, ev: str) -> list[str]:
    """LCS length per pair of ``ev(id, generated, reference)`` on metric
    tokens: ``{name}(pair_id, lcs, n_gen, n_ref)``. A recursive CTE adds
    one DP row per step; a row is a running max over j of
    ``max(prev[j], prev[j-1] + 1 if the tokens match)``, which equals the
    usual recurrence because neighbouring DP cells differ by at most one.
    Needs ``sql(..., recursive=True)``."""
    return [
        f"{name}_tok AS (SELECT id AS pair_id, {words('generated')} AS a, {words('reference')} AS b FROM {ev})",
        f"""{name}_bt AS (SELECT pair_id, unnest(generate_series(1, len(b))) AS j, unnest(b) AS bj
  FROM {name}_tok)""",
        f"""{name}_dp(pair_id, i, j, v) AS (
  SELECT pair_id, 0, j, 0 FROM (SELECT pair_id, unnest(range(0, len(b) + 1)) AS j FROM {name}_tok)
  UNION ALL
  SELECT pair_id, i, j, max(e) OVER (PARTITION BY pair_id ORDER BY j ROWS UNBOUNDED PRECEDING)
  FROM (SELECT d.pair_id, d.i + 1 AS i, d.j,
          greatest(d.v, CASE WHEN bt.bj = t.a[d.i + 1]
                             THEN lag(d.v) OVER (PARTITION BY d.pair_id ORDER BY d.j) + 1 ELSE 0 END) AS e
        FROM {name}_dp d JOIN {name}_tok t ON t.pair_id = d.pair_id
        LEFT JOIN {name}_bt bt ON bt.pair_id = d.pair_id AND bt.j = d.j
        WHERE d.i < len(t.a)))""",
        f"""{name}_l AS (SELECT t.pair_id, d.v AS lcs, len(t.a) AS n_gen, len(t.b) AS n_ref
  FROM {name}_tok t JOIN {name}_dp d ON d.pair_id = t.pair_id AND d.i = len(t.a) AND d.j = len(t.b))""",
        f"""{name}_p AS (SELECT pair_id, lcs,
  CASE WHEN n_gen > 0 THEN lcs / n_gen ELSE 0.0 END AS precision,
  CASE WHEN n_ref > 0 THEN lcs / n_ref ELSE 0.0 END AS recall FROM {name}_l)""",
        f"""{name} AS (SELECT pair_id, lcs, precision, recall,
  CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM {name}_p)""",
    ]


def _any(text: str, markers, fn: str) -> str:
    return "(" + " OR ".join(f"{fn}({text}, {lit(m)})" for m in markers) + ")"


def judge_ctes(name: str, ev: str, cos: str) -> list[str]:
    """M5 + M6 over ``ev`` with ``cos(pair_id, cosine)``:
    ``{name}(pair_id, <dims>)``."""
    sig = f"""{name}_s AS (SELECT e.id AS pair_id, c.cosine AS sem,
    CASE WHEN len(list_distinct({words('e.reference')})) > 0
         THEN len(list_intersect(list_distinct({words('e.reference')}), {words(strip('e.generated'))}))
              / len(list_distinct({words('e.reference')}))
         ELSE 0.0 END AS cov,
    {strip('e.generated')} AS cand,
    lower({strip('e.generated')}) AS l,
    length(coalesce(e.customer_email, '')) - length(replace(coalesce(e.customer_email, ''), '?', '')) AS asks
  FROM {ev} e JOIN {cos} c ON c.pair_id = e.id)"""
    flags = f"""{name}_f AS (SELECT pair_id, sem, cov, cand,
    {_any('l', GREETING_PREFIXES, 'starts_with')} AS greeting,
    {_any('l', CLOSING_MARKERS, 'contains')} AS closing,
    {_any('l', ACTION_MARKERS, 'contains')} AS action,
    {_any('l', EMPATHY_MARKERS, 'contains')} AS empathy,
    (length(cand) > 0 AND upper(left(cand, 1)) = left(cand, 1) AND lower(left(cand, 1)) <> left(cand, 1)
      AND {_any('cand', SENTENCE_ENDINGS, 'ends_with')}) AS grammar_ok,
    asks
  FROM {name}_s)"""
    dims = {
        "correctness": band("0.5 * sem + 0.5 * cov"),
        "professionalism": "CASE WHEN greeting AND closing THEN 5 WHEN greeting THEN 4 ELSE 3 END",
        "empathy": "CASE WHEN empathy THEN 5 ELSE 3 END",
        "completeness": band("0.4 * cov + 0.3 * sem + CASE WHEN asks = 0 OR action THEN 0.3 ELSE 0.0 END"),
        "grammar": "CASE WHEN grammar_ok THEN 4 ELSE 3 END",
        "tone": f"CASE WHEN greeting THEN {band('sem')} ELSE greatest(2, {band('sem')} - 1) END",
        "actionability": "CASE WHEN action THEN 5 ELSE 2 END",
    }
    cols = ", ".join(f"CAST({dims.get(d, str(NEUTRAL))} AS INTEGER) AS {d}" for d in RUBRIC)
    two = lambda x: f"round_even({x} * 100.0, 0) / 100.0"
    said = lambda x: f"CASE WHEN {x} THEN 'True' ELSE 'False' END"
    why = (f"printf('heuristic: sem=%.2f, coverage=%.2f, len=%d, greeting=%s, action=%s', "
           f"{two('sem')}, {two('cov')}, len({words('cand')}), {said('greeting')}, {said('action')})")
    return [sig, flags, f"{name} AS (SELECT pair_id, {cols}, {why} AS judge_rationale FROM {name}_f)"]


def encoder_ctes(name: str, src: str, keys: str, text: str) -> list[str]:
    """Unit vectors ``v`` of the stand-in encoder: 16-bit numbers of the md5."""
    t = f"CASE WHEN trim(coalesce({text}, '')) = '' THEN ' ' ELSE {text} END"
    return [
        f"""{name}_raw AS (SELECT {keys}, list_transform(range(0, 8), lambda i: CAST(('0x' ||
  substr(md5({t}), CAST(4 * i + 1 AS INTEGER), 4)) AS BIGINT) - 32767.5) AS v FROM {src})""",
        f"""{name} AS (SELECT {keys}, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v,
  lambda y: y * y)))::DOUBLE) AS v FROM {name}_raw)"""]


def encoded_alignment_ctes(name: str) -> list[str]:
    """Token alignment of all evaluation pairs with the stand-in encoder."""
    return [
        f"""{name}_w AS (SELECT pair_id, side, word, count(*) AS cnt FROM (
  SELECT pair_id, side, unnest(CASE WHEN len(t) = 0 THEN [' '] ELSE t END) AS word FROM (
    SELECT id AS pair_id, 'g' AS side, {words('generated')} AS t FROM eval_pairs
    UNION ALL SELECT id, 'r', {words('reference')} FROM eval_pairs)) GROUP BY ALL)""",
        f"{name}_d AS (SELECT DISTINCT word FROM {name}_w)",
        *encoder_ctes(f"{name}_e", f"{name}_d", "word", "word"),
        f"""{name}_s AS (SELECT g.pair_id, g.word AS gw, r.word AS rw, g.cnt AS gc, r.cnt AS rc,
  list_dot_product(a.v, b.v) AS s FROM {name}_w g JOIN {name}_w r
    ON g.pair_id = r.pair_id AND g.side = 'g' AND r.side = 'r'
  JOIN {name}_e a ON a.word = g.word JOIN {name}_e b ON b.word = r.word)""",
        f"""{name}_p AS (SELECT pair_id, sum(c * m) / sum(c) AS p FROM (
  SELECT pair_id, gw, max(s) AS m, any_value(gc) AS c FROM {name}_s GROUP BY ALL) GROUP BY pair_id)""",
        f"""{name}_r AS (SELECT pair_id, sum(c * m) / sum(c) AS r FROM (
  SELECT pair_id, rw, max(s) AS m, any_value(rc) AS c FROM {name}_s GROUP BY ALL) GROUP BY pair_id)""",
        f"""{name} AS (SELECT pair_id, greatest(p, 0.0) AS precision, greatest(r, 0.0) AS recall,
  greatest(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 0.0) AS f1
  FROM {name}_p JOIN {name}_r USING (pair_id))"""]


def llm_judge_sql() -> str:
    """The stand-in judge: what it says follows from its prompt's length."""
    def dim(d: str) -> str:
        said = {"correctness": "least(greatest(n % 9, 1), 5)",
                "tone": "least(greatest(round_even((n % 4) + 0.5, 0), 1), 5)"}.get(d, "3")
        return (f"CAST(CASE WHEN n % 5 IN (0, 2) THEN j.{d} WHEN n % 5 = 1 THEN 3 ELSE {said} END "
                f"AS INTEGER) AS {d}")
    return sql(EVAL_VOCAB + cosine_ctes("c", "eval_pairs", "ev_vocab")
               + judge_ctes("j", "eval_pairs", "c")
               + [f"q AS (SELECT id, length(judge_prompt) AS n FROM ({judge_prompt_sql()}))"],
               f"SELECT q.id, {', '.join(dim(d) for d in RUBRIC)}, CASE WHEN n % 5 IN (0, 2) "
               f"THEN j.judge_rationale WHEN n % 5 = 1 THEN '' ELSE 'n=' || CAST(n AS VARCHAR) END "
               f"AS judge_rationale, CASE WHEN n % 5 IN (0, 2) THEN 'heuristic' ELSE 'length' END "
               f"AS judge_backend FROM q JOIN j ON j.pair_id = q.id")


def score_ctes(name: str, ev: str, vocab: str) -> list[str]:
    """Score rows over ``ev(id, category, customer_email, generated,
    reference)`` with ``vocab``: ``{name}(<SCORE_COLS>)``."""
    total = " + ".join(f"j.{d}" for d in RUBRIC)
    avg = f"(CAST({total} AS DOUBLE) / {float(len(RUBRIC))})"
    norm = f"(({avg} - 1.0) / 4.0)"
    final = f"100.0 * ({W.llm_judge} * {norm} + {W.bertscore} * a.f1 + {W.cosine} * c.cosine)"
    dims = ", ".join(f"j.{d}" for d in RUBRIC)
    return [
        *cosine_ctes(f"{name}_cos", ev, vocab),
        *alignment_ctes(f"{name}_ta", ev, vocab),
        *judge_ctes(f"{name}_j", ev, f"{name}_cos"),
        f"""{name} AS (SELECT e.id, e.category, {rnd('c.cosine', 4)} AS cosine,
  {rnd('a.precision', 4)} AS bertscore_precision, {rnd('a.recall', 4)} AS bertscore_recall,
  {rnd('a.f1', 4)} AS bertscore_f1, {rnd(avg, 3)} AS judge_avg_1to5,
  {rnd(norm, 4)} AS judge_normalized, {rnd(final, 2)} AS final_score, {dims}
  FROM {ev} e JOIN {name}_cos c ON c.pair_id = e.id JOIN {name}_ta a ON a.pair_id = e.id
  JOIN {name}_j j ON j.pair_id = e.id)""",
    ]


def ticket_run_ctes() -> list[str]:
    """The whole ticket run up to the score rows (``scores``)."""
    case_score = f"printf('%.2f', round_even(c.score * 100.0, 0) / 100.0)"
    block = (f"'--- Example ' || CAST(c.rank AS VARCHAR) || ' (category: ' || c.category || "
             f"', similarity: ' || {case_score} || ') ---' || {NL} || 'Customer: ' || "
             f"c.customer_email || {NL} || 'Agent reply: ' || CASE WHEN c.rank = 1 THEN "
             f"{lit(TOP_OPEN)} ELSE '' END || c.support_reply || CASE WHEN c.rank = 1 THEN "
             f"{lit(TOP_CLOSE)} ELSE '' END || {NL}")
    return [
        *GIVEN, *SPLIT,
        *vocab_ctes("kbv", "kb_corpus", "CAST(doc_id AS VARCHAR) || ':' || side", "text"),
        *vector_ctes("kbvec", "kb", ["id"], "customer_email", "kbv"),
        "queries AS (SELECT id AS query_id, customer_email AS query_email FROM holdout)",
        *vector_ctes("qvec", "queries", ["query_id"], "query_email", "kbv"),
        *topk_ctes("top", "qvec", "kbvec", "queries", "kb", True),
        """cases AS (SELECT t.query_id, t.rank, t.id, t.score, k.customer_email, k.support_reply,
  k.category FROM top t JOIN kb k ON k.id = t.id)""",
        f"""prompts AS (SELECT q.query_id, q.query_email,
  {lit(PROMPT_HEADER)} || {NL} || coalesce(
    (SELECT string_agg({block}, {NL} ORDER BY c.rank) FROM cases c WHERE c.query_id = q.query_id)
    || {NL}, '') || {lit(PROMPT_TASK)} || q.query_email || {lit(PROMPT_TAIL)} AS user_prompt,
  (SELECT c.support_reply FROM cases c WHERE c.query_id = q.query_id AND c.rank = 1) AS top_reply
  FROM queries q)""",
        f"""generations AS (SELECT query_id, query_email,
  CASE WHEN top_reply IS NOT NULL THEN {lit(GROUNDED_PREFIX)} || {strip('top_reply')}
       ELSE {lit(GENERIC_REPLY)} END AS reply FROM prompts)""",
        """ev AS (SELECT h.id, h.category, h.customer_email, g.reply AS generated,
  h.support_reply AS reference FROM holdout h JOIN generations g ON g.query_id = h.id)""",
        *score_ctes("scores", "ev", "kbv"),
    ]


def pair_retrieval(queries_cte: str, exclude: bool, kb: str = "pairs",
                   out: str = "query_id, rank, id", src: str = "top") -> str:
    return sql([
        PAIRS,
        """pcorpus AS (SELECT id AS doc_id, 'email' AS side, customer_email AS text FROM pairs
  UNION ALL SELECT id AS doc_id, 'reply' AS side, support_reply AS text FROM pairs)""",
        *vocab_ctes("pv", "pcorpus", "CAST(doc_id AS VARCHAR) || ':' || side", "text"),
        f"kb AS (SELECT * FROM {kb})",
        *vector_ctes("kbvec", "kb", ["id"], "customer_email", "pv"),
        queries_cte,
        *vector_ctes("qvec", "queries", ["query_id"], "query_email", "pv"),
        *topk_ctes("top", "qvec", "kbvec", "queries", "kb", exclude),
    ], f"SELECT {out}, {rnd('score')} AS score FROM {src}")


PAIR_QUERIES = "queries AS (SELECT id AS query_id, customer_email AS query_email FROM pairs)"

EVAL_VOCAB = [
    PAIRS, EVAL_PAIRS,
    """ecorpus AS (SELECT id AS doc_id, 'email' AS side, customer_email AS text FROM eval_pairs
  UNION ALL SELECT id AS doc_id, 'reply' AS side, reference AS text FROM eval_pairs)""",
    *vocab_ctes("ev_vocab", "ecorpus", "CAST(doc_id AS VARCHAR) || ':' || side", "text"),
]

SCORE_COLS = ("id, category, cosine, bertscore_precision, bertscore_recall, bertscore_f1, "
              "judge_avg_1to5, judge_normalized, final_score, " + ", ".join(RUBRIC))


def describe(value: str) -> str:
    return (f"count({value}) AS count, coalesce({mean(value, 2)}, 0.0) AS mean, "
            f"coalesce({middle(value, 2)}, 0.0) AS median, "
            f"coalesce({rnd(f'min({value})', 2)}, 0.0) AS min, "
            f"coalesce({rnd(f'max({value})', 2)}, 0.0) AS max, "
            f"coalesce({rnd(f'stddev_pop({value})', 2)}, 0.0) AS stdev")


def judge_parse_sql() -> str:
    good = ("'Verdict {\"correctness\": ' || CAST(quality * 4 + 1 AS VARCHAR) || "
            "', \"tone\": \"' || CAST(5 - toxic * 3 AS VARCHAR) || "
            "'\", \"empathy\": null, \"grammar\": 2.5, \"actionability\": 7, "
            "\"rationale\": \"doc ' || CAST(doc_id AS VARCHAR) || '\"} end'")
    reply = (f"CASE WHEN doc_id % 7 = 0 THEN 'no verdict given' "
             f"WHEN doc_id % 11 = 0 THEN '{{\"correctness\": 4, \"tone\": }}' ELSE {good} END")
    dims = []
    for d in RUBRIC:
        x = f"TRY_CAST(CASE WHEN json_valid(span) THEN json_extract_string(span, '$.{d}') END AS DOUBLE)"
        dims.append(f"CASE WHEN {x} IS NULL OR isnan({x}) THEN {NEUTRAL} ELSE "
                    f"CAST(least(greatest(round_even({x}, 0), 1.0), 5.0) AS INTEGER) END AS {d}")
    rationale = (f"substr(coalesce(CASE WHEN json_valid(span) THEN "
                 f"json_extract_string(span, '$.rationale') END, ''), 1, {RATIONALE_MAX})")
    # What the odd replies give is known; a dimension they don't name scores 3.
    values = ", ".join(f"({i}, {ok}, {score}, {lit(why)})"
                       for i, (_, ok, score, why) in enumerate(ODD_REPLIES))
    odd = ", ".join(f"o.score AS {d}" if d == "correctness" else f"{NEUTRAL} AS {d}" for d in RUBRIC)
    return sql([
        f"odd(i, ok, score, why) AS (VALUES {values})",
        f"r AS (SELECT doc_id, {reply} AS reply FROM labels "
        f"WHERE doc_id % {ODD_EVERY} NOT IN (SELECT i FROM odd))",
        "s AS (SELECT doc_id, regexp_extract(reply, '(?s)\\{.*\\}', 0) AS span FROM r)",
    ], f"SELECT doc_id, (length(span) = 0 OR json_valid(span)) AS ok, {', '.join(dims)}, "
       f"{rationale} AS rationale FROM s UNION ALL SELECT doc_id, o.ok, {odd}, o.why AS rationale "
       f"FROM labels JOIN odd o ON o.i = doc_id % {ODD_EVERY}")


def judge_prompt_sql() -> str:
    keys = ", ".join(f'"{d}"' for d in RUBRIC)
    prompt = (f"{lit(JUDGE_INTRO)} || 'CUSTOMER EMAIL:' || {NL} || coalesce(customer_email, '') || "
              f"{NL} || {NL} || 'REFERENCE REPLY:' || {NL} || coalesce(reference, '') || {NL} || {NL} || "
              f"'CANDIDATE REPLY:' || {NL} || coalesce(generated, '') || {NL} || {NL} || "
              f"{lit(JUDGE_OUTRO % keys)}")
    return sql([PAIRS, EVAL_PAIRS], f"SELECT id, {prompt} AS judge_prompt FROM eval_pairs")


def _fmt(x: str) -> str:
    return f"regexp_replace(regexp_replace(printf('%.6f', {x}), '0+$', ''), '\\.$', '.0')"


def _pad(x: str, width: int, left: bool) -> str:
    fn = "lpad" if left else "rpad"
    return f"CASE WHEN length({x}) >= {width} THEN {x} ELSE {fn}({x}, {width}, ' ') END"


def summary_text_sql(run: list[str], ev: str = "eval_pairs") -> str:
    eq, dash = lit("=" * RULE_WIDTH), lit("-" * RULE_WIDTH)
    weights = (f"' Weights          : {{''llm_judge'': ' || {_fmt(repr(W.llm_judge))} || "
               f"', ''bertscore'': ' || {_fmt(repr(W.bertscore))} || ', ''cosine'': ' || "
               f"{_fmt(repr(W.cosine))} || '}}'")
    head = [eq, lit(SUMMARY_TITLE), eq, "' Emails evaluated : ' || CAST(o.count AS VARCHAR)",
            "' Embedder         : tfidf'", "' Judge backend    : heuristic'",
            "' BERTScore backend: fallback-wordsim'", weights, dash,
            "' OVERALL FINAL SCORE (0-100)'",
            (f"'   mean=' || {_fmt('o.mean')} || '  median=' || {_fmt('o.median')} || "
             f"'  min=' || {_fmt('o.min')} || '  max=' || {_fmt('o.max')} || "
             f"'  stdev=' || {_fmt('o.stdev')}"),
            dash, "' COMPONENT MEANS (0-1)'",
            f"'   LLM judge (norm) : ' || {_fmt('c.judge_normalized')}",
            f"'   BERTScore F1     : ' || {_fmt('c.bertscore_f1')}",
            f"'   Cosine           : ' || {_fmt('c.cosine')}",
            f"'   ROUGE-L F1 (diag): ' || {_fmt('c.rouge_l_f1')}",
            dash, "' PER-CATEGORY FINAL SCORE (mean / count)'"]
    fixed = " UNION ALL ".join(f"SELECT {i} AS line_no, {line} AS line FROM o, c"
                               for i, line in enumerate(head))
    n = len(head)
    cat_line = (f"'   ' || {_pad('category', CATEGORY_WIDTH, False)} || ' ' || "
                f"{_pad(_fmt('mean'), 6, True)} || '   (n=' || CAST(count AS VARCHAR) || ')'")
    return sql(run + lcs_ctes("rl", ev) + [
        f"o AS (SELECT {describe('final_score')} FROM scores)",
        f"""c AS (SELECT coalesce({mean('s.cosine', 4)}, 0.0) AS cosine,
  coalesce({mean('s.bertscore_f1', 4)}, 0.0) AS bertscore_f1,
  coalesce({mean('s.judge_normalized', 4)}, 0.0) AS judge_normalized,
  coalesce({mean(rnd('r.f1', 4), 4)}, 0.0) AS rouge_l_f1
  FROM scores s JOIN rl r ON r.pair_id = s.id)""",
        f"pc AS (SELECT category, {describe('final_score')} FROM scores GROUP BY category)",
        f"""body AS (SELECT CAST(row_number() OVER (ORDER BY category) + {n - 1} AS BIGINT) AS line_no,
  {cat_line} AS line FROM pc)"""],
        f"SELECT CAST(line_no AS BIGINT) AS line_no, line FROM ({fixed}) UNION ALL "
        f"SELECT line_no, line FROM body UNION ALL "
        f"SELECT CAST(count(*) + {n} AS BIGINT) AS line_no, {eq} AS line FROM pc", recursive=True)


def oracles() -> dict[str, str]:
    run = ticket_run_ctes()
    all_scores = EVAL_VOCAB + score_ctes("scores", "eval_pairs", "ev_vocab")
    return {
        "pairs_from_conversations": sql(
            [PAIRS], "SELECT id, category, customer_email, support_reply FROM pairs"),
        "eval_pairs": sql([PAIRS, EVAL_PAIRS], "SELECT * FROM eval_pairs"),
        "ticket_generate": sql(tickets_ctes(),
                               "SELECT id, category, customer_email, support_reply FROM tickets"),
        "holdout_split": sql(GIVEN + SPLIT, "SELECT id, category, holdout_rank FROM holdout"),
        "kb_anti": sql(GIVEN + SPLIT, "SELECT id, category FROM kb"),
        "corpus_union": sql(GIVEN + SPLIT, "SELECT doc_id, side, text FROM kb_corpus"),
        "distinct_categories": sql(GIVEN,
                                   "SELECT count(DISTINCT category) AS n_categories FROM tickets"),
        "tokenize_words": (f"SELECT doc_id, len(w) AS n_words, array_to_string(w, ' ') AS words "
                           f"FROM (SELECT doc_id, {words('text')} AS w FROM documents)"),
        "tfidf_terms": sql([f"u AS (SELECT doc_id, {uni('text')} AS u FROM documents)",
                            f"t AS (SELECT doc_id, {with_bigrams('u')} AS t FROM u)"],
                           "SELECT doc_id, len(t) AS n_terms, array_to_string(t, '|') AS terms FROM t"),
        "tfidf_vocab": sql([PAIRS, """pcorpus AS (
  SELECT id AS doc_id, 'email' AS side, customer_email AS text FROM pairs
  UNION ALL SELECT id AS doc_id, 'reply' AS side, support_reply AS text FROM pairs)""",
                            *vocab_ctes("v", "pcorpus", "CAST(doc_id AS VARCHAR) || ':' || side",
                                        "text")],
                           f"SELECT term, tf, df, {rnd('idf')} AS idf FROM v"),
        "tfidf_vocab_documents": sql(vocab_ctes("v", "documents", "doc_id", "text"),
                                     f"SELECT term, tf, df, {rnd('idf')} AS idf FROM v"),
        "tfidf_vectors": sql(vocab_ctes("v", "documents", "doc_id", "text")
                             + vector_ctes("dv", "documents", ["doc_id"], "text", "v"),
                             f"SELECT doc_id, term, {rnd('w')} AS w FROM dv"),
        "l2_normalize_dense": sql(
            ["n AS (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, "
             "lambda x: x::DOUBLE * x::DOUBLE))) AS norm FROM embeddings)"],
            f"SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS pos, "
            f"{rnd('unnest(embedding)::DOUBLE / CASE WHEN norm = 0 THEN 1.0 ELSE norm END')} AS x "
            f"FROM n"),
        "topk_sparse": pair_retrieval(PAIR_QUERIES, False),
        "topk_self_excluded": pair_retrieval(PAIR_QUERIES, True),
        "topk_zero_pad": pair_retrieval(
            "queries AS (SELECT item_id AS query_id, text AS query_email FROM benchmark)", False),
        "topk_dense": sql([
            """s AS (SELECT q.vec_id AS query_id, d.vec_id AS id,
  list_dot_product(q.embedding::DOUBLE[], d.embedding::DOUBLE[]) AS score
  FROM embeddings q JOIN embeddings d ON q.vec_id <> d.vec_id)""",
            f"""r AS (SELECT *, row_number() OVER (PARTITION BY query_id
  ORDER BY round(score, 9) DESC, id) AS rank FROM s QUALIFY rank <= {K})"""],
            f"SELECT query_id, rank, id, {rnd('score')} AS score FROM r"),
        "topk_indexed": pair_retrieval(PAIR_QUERIES, True, "pairs WHERE category <> 'c1'"),
        "cases_without_ids": pair_retrieval(
            "queries AS (SELECT row_number() OVER () AS query_id, text AS query_email "
            "FROM benchmark)", False, out="q.query_email, rank, id",
            src="top JOIN queries q USING (query_id)"),
        "holdout_limit": sql(GIVEN + SPLIT, f"SELECT id, category, holdout_rank FROM holdout "
                                            f"ORDER BY category, holdout_rank, id LIMIT {LIMIT}"),
        "retrieved_cases": sql(run, f"SELECT query_id, rank, id, {rnd('score')} AS score, category "
                                    f"FROM cases"),
        "fewshot_prompt": sql(run, "SELECT query_id, user_prompt FROM prompts"),
        "grounded_reply": sql(run, "SELECT query_id, reply FROM generations"),
        "retrieval_hit_rate": sql(run, f"""SELECT h.category, count(DISTINCT h.id) AS n_queries,
  count(c.category) AS n_cases,
  {rnd("sum(CASE WHEN c.rank = 1 AND c.category = h.category THEN 1.0 ELSE 0.0 END) / count(DISTINCT h.id)")} AS top1_hit_rate,
  {rnd("coalesce(avg(CASE WHEN c.category IS NULL THEN NULL WHEN c.category = h.category THEN 1.0 ELSE 0.0 END), 0.0)")} AS case_hit_rate
  FROM holdout h LEFT JOIN cases c ON c.query_id = h.id GROUP BY h.category"""),
        "cosine_pairs": sql(EVAL_VOCAB + cosine_ctes("c", "eval_pairs", "ev_vocab"),
                            f"SELECT pair_id AS id, {rnd('cosine')} AS cosine FROM c"),
        "cosine_dense_pairs": (
            "SELECT a.vec_id, b.vec_id AS next_id, "
            + rnd("least(greatest(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), "
                  "0.0), 1.0)")
            + " AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"),
        "token_alignment_prf": sql(EVAL_VOCAB + alignment_ctes("t", "eval_pairs", "ev_vocab"),
                                   f"SELECT pair_id AS id, {rnd('precision')} AS precision, "
                                   f"{rnd('recall')} AS recall, {rnd('f1')} AS f1 FROM t"),
        "token_alignment_vectors": sql(
            [PAIRS, EVAL_PAIRS, *encoded_alignment_ctes("a")],
            f"SELECT pair_id, {rnd('precision')} AS precision, {rnd('recall')} AS recall, "
            f"{rnd('f1')} AS f1 FROM a"),
        "coverage": sql([PAIRS, EVAL_PAIRS], (
            f"SELECT id, {rnd('CASE WHEN len(rt) > 0 THEN len(list_intersect(rt, ct)) / len(rt) ELSE 0.0 END')}"
            f" AS coverage FROM (SELECT id, list_distinct({words('reference')}) AS rt, "
            f"{words(strip('generated'))} AS ct FROM eval_pairs)")),
        "heuristic_judge": sql(EVAL_VOCAB + cosine_ctes("c", "eval_pairs", "ev_vocab")
                               + judge_ctes("j", "eval_pairs", "c"),
                               f"SELECT pair_id AS id, {', '.join(RUBRIC)}, judge_rationale FROM j"),
        "rouge_l": sql([PAIRS, EVAL_PAIRS, *lcs_ctes("rl", "eval_pairs")],
                       f"SELECT pair_id AS id, lcs, {rnd('precision')} AS precision, "
                       f"{rnd('recall')} AS recall, {rnd('f1')} AS f1 FROM rl", recursive=True),
        "metric_medians": sql(
            EVAL_VOCAB + cosine_ctes("c", "eval_pairs", "ev_vocab") + lcs_ctes("rl", "eval_pairs"),
            f"SELECT e.category, count(*) AS n, {rnd('median(c.cosine)')} AS median_cosine, "
            f"{rnd('median(rl.f1)')} AS median_rouge_l FROM eval_pairs e JOIN c ON c.pair_id = e.id "
            f"JOIN rl ON rl.pair_id = e.id GROUP BY e.category", recursive=True),
        "component_means": sql(all_scores + lcs_ctes("rl", "eval_pairs"), (
            f"SELECT coalesce({mean('s.cosine', 4)}, 0.0) AS cosine, "
            f"coalesce({mean('s.bertscore_f1', 4)}, 0.0) AS bertscore_f1, "
            f"coalesce({mean('s.judge_normalized', 4)}, 0.0) AS judge_normalized, "
            f"coalesce({mean(rnd('r.f1', 4), 4)}, 0.0) AS rouge_l_f1 "
            f"FROM scores s JOIN rl r ON r.pair_id = s.id"), recursive=True),
        "scores_wide": sql(all_scores + lcs_ctes("rl", "eval_pairs"), (
            "SELECT s.cosine, s.bertscore_precision, s.bertscore_recall, s.bertscore_f1, "
            "'fallback-wordsim' AS bertscore_backend, s.judge_avg_1to5, s.judge_normalized, "
            "'heuristic' AS judge_backend, s.final_score, s.id, s.category, "
            f"{rnd('r.f1', 4)} AS rouge_l_f1, "
            + ", ".join(f"s.{d} AS judge_{d}" for d in RUBRIC)
            + " FROM scores s JOIN rl r ON r.pair_id = s.id"), recursive=True),
        "summary_text": summary_text_sql(all_scores),
        "judge_prompt": judge_prompt_sql(),
        "judge_parse": judge_parse_sql(),
        "score_rows": sql(run, f"SELECT {SCORE_COLS} FROM scores"),
        "final_score": sql(run, "SELECT id, final_score FROM scores"),
        "describe_overall": sql(all_scores, f"SELECT {describe('final_score')} FROM scores"),
        "describe_by_category": sql(all_scores, f"SELECT category, {describe('final_score')} FROM scores "
                                         f"GROUP BY category ORDER BY category"),
        "summary_table": sql(all_scores, f"SELECT category, grouping(category) = 1 AS is_overall, "
                                  f"{describe('final_score')} FROM scores "
                                  f"GROUP BY ROLLUP (category)"),
        "run_meta": sql(all_scores, f"SELECT count(*) AS n_evaluated, {W.llm_judge}::DOUBLE AS weight_llm_judge, "
                             f"{W.bertscore}::DOUBLE AS weight_bertscore, {W.cosine}::DOUBLE AS weight_cosine, "
                             f"'tfidf' AS embedder, 'heuristic' AS judge_backend, "
                             f"'fallback-wordsim' AS bertscore_backend FROM scores"),
        "generated_report": sql(run, """SELECT h.id, h.category, h.customer_email,
  g.reply AS generated_reply, h.support_reply AS reference_reply, 'grounded' AS provider,
  coalesce((SELECT string_agg(CAST(c.id AS VARCHAR), '|' ORDER BY c.rank) FROM cases c
            WHERE c.query_id = h.id), '') AS retrieved_ids
  FROM holdout h JOIN generations g ON g.query_id = h.id"""),
        "llm_complete_stub": sql([f"p AS ({judge_prompt_sql()})"], (
            "SELECT id AS pair_id, regexp_extract(judge_prompt, '([^\\n]*\\S[^\\n]*)\\s*$', 1) "
            "AS completion, 'echo' AS backend, CAST(NULL AS VARCHAR) AS error FROM p")),
        "encode_texts": sql(encoder_ctes("e", "documents", "doc_id", "text"),
                            f"SELECT doc_id, CAST(generate_subscripts(v, 1) - 1 AS BIGINT) AS pos, "
                            f"{rnd('unnest(v)')} AS x FROM e"),
        "topk_encoded": sql([
            PAIRS, *encoder_ctes("e", "pairs", "id", "customer_email"),
            """s AS (SELECT q.id AS query_id, d.id, list_dot_product(q.v, d.v) AS score
  FROM e q JOIN e d ON q.id <> d.id)""",
            f"""r AS (SELECT *, row_number() OVER (PARTITION BY query_id
  ORDER BY round(score, 9) DESC, id) AS rank FROM s QUALIFY rank <= {K})"""],
            f"SELECT query_id, rank, id, {rnd('score')} AS score FROM r"),
        "evaluate_encoded": sql([
            PAIRS, EVAL_PAIRS, *encoded_alignment_ctes("a"),
            *encoder_ctes("eg", "eval_pairs", "id", "generated"),
            *encoder_ctes("er", "eval_pairs", "id", "reference")],
            f"SELECT eg.id, {rnd('least(greatest(list_dot_product(eg.v, er.v), 0.0), 1.0)', 4)} AS cosine, "
            f"{rnd('a.precision', 4)} AS bertscore_precision, {rnd('a.recall', 4)} AS bertscore_recall, "
            f"{rnd('a.f1', 4)} AS bertscore_f1, 'token-vectors' AS bertscore_backend "
            f"FROM eg JOIN er ON er.id = eg.id JOIN a ON a.pair_id = eg.id"),
        "llm_judge": llm_judge_sql(),
        "tickets_csv": sql([PAIRS], (
            "SELECT id, customer_email, category, CASE id % 6 WHEN 0 THEN '  ' || support_reply "
            "|| chr(9) || ' ' WHEN 1 THEN 'a \"b\", c' || chr(10) || support_reply WHEN 2 THEN '' "
            "WHEN 3 THEN NULL ELSE support_reply END AS support_reply FROM pairs")),
        "per_email_json": sql(all_scores, "SELECT id, final_score, " + " || ',' || ".join(
            f"CAST({d} AS VARCHAR)" for d in RUBRIC) + " AS dimensions FROM scores"),
        "report_files": (f"SELECT line, count(*) AS n FROM ({summary_text_sql(run, 'ev')}) "
                         "GROUP BY line"),
        "evaluate_pairs": sql(EVAL_VOCAB + score_ctes("scores", "eval_pairs", "ev_vocab"),
                              f"SELECT {SCORE_COLS} FROM scores"),
    }
