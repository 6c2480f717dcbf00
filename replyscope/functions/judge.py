"""Rubric judge as column expressions: the heuristic judge (M6), the judge
prompt (M7), judge-reply parsing (M8) and the judge average (M10)."""
from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT_RUBRIC
from .text import strip, word_tokens

# Heuristic judge lexicon and constants.
GREETING_PREFIXES = ("hi", "hello", "thanks", "thank")
CLOSING_MARKERS = ("let me know", "—", "regards", "happy to help")
ACTION_MARKERS = ("i've", "i have", "i will", "i'll", "processed", "shipped",
                  "sent", "refund", "replacement", "cancelled", "reset", "arrange")
EMPATHY_MARKERS = ("sorry", "understand", "apolog", "concern")
SENTENCE_ENDINGS = (".", "!", "—")
NEUTRAL = 3
RATIONALE_MAX = 400

# Judge prompt texts.
JUDGE_SYSTEM = (
    "You are a strict but fair QA reviewer for customer-support replies. "
    "You score a candidate reply against a rubric. Output ONLY valid JSON."
)
JUDGE_INTRO = (
    "Score the CANDIDATE reply to the customer email below.\n"
    "The REFERENCE is one example of a good reply (not the only correct "
    "answer) — reward a candidate that is correct and helpful even if it "
    "differs from the reference.\n\n"
)
JUDGE_OUTRO = (
    "Rate each dimension from 1 (poor) to 5 (excellent). Return JSON with "
    "exactly these integer keys: {%s} plus a short string key "
    '"rationale". No text outside the JSON.'
)


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def band(x: Column) -> Column:
    """Map [0, 1] to 1..5: ``clamp(round_half_even(1 + 4x), 1, 5)``."""
    return F.least(F.greatest(F.rint(F.lit(1.0) + F.lit(4.0) * x), F.lit(1.0)),
                   F.lit(5.0)).cast("int")


def _any_contains(text: Column, markers) -> Column:
    out = F.lit(False)
    for m in markers:
        out = out | text.contains(m)
    return out


def signals(email: str | Column, candidate: str | Column) -> dict[str, Column]:
    """Boolean and count signals of the heuristic judge."""
    cand = strip(F.coalesce(_c(candidate), F.lit("")))
    low = F.lower(cand)
    greeting = F.lit(False)
    for g in GREETING_PREFIXES:
        greeting = greeting | low.startswith(g)
    action = _any_contains(low, ACTION_MARKERS)
    first = F.substring(cand, 1, 1)
    upper_first = (F.length(cand) > 0) & (F.upper(first) == first) & (F.lower(first) != first)
    ends = F.lit(False)
    for e in SENTENCE_ENDINGS:
        ends = ends | cand.endswith(e)
    asks = F.length(F.coalesce(_c(email), F.lit(""))) - F.length(
        F.replace(F.coalesce(_c(email), F.lit("")), F.lit("?"), F.lit("")))
    return {
        "cand": cand,
        "greeting": greeting,
        "closing": _any_contains(low, CLOSING_MARKERS),
        "action": action,
        "empathy": _any_contains(low, EMPATHY_MARKERS),
        "grammar_ok": upper_first & ends,
        "addresses_q": (asks == 0) | action,
        "words": F.size(word_tokens(cand)),
    }


def heuristic_dimensions(email: str | Column, candidate: str | Column,
                         sem: Column, cov: Column) -> dict[str, Column]:
    """M6: the seven 1-5 scores from ``sem`` (M1 cosine of candidate and
    reference) and ``cov`` (M5 coverage)."""
    s = signals(email, candidate)
    five, four, three, two = (F.lit(v) for v in (5, 4, 3, 2))
    tone_band = band(sem)
    return {
        "correctness": band(F.lit(0.5) * sem + F.lit(0.5) * cov),
        "professionalism": F.when(s["greeting"] & s["closing"], five)
                            .when(s["greeting"], four).otherwise(three),
        "empathy": F.when(s["empathy"], five).otherwise(three),
        "completeness": band(F.lit(0.4) * cov + F.lit(0.3) * sem
                             + F.when(s["addresses_q"], F.lit(0.3)).otherwise(F.lit(0.0))),
        "grammar": F.when(s["grammar_ok"], four).otherwise(three),
        "tone": F.when(s["greeting"], tone_band).otherwise(F.greatest(two, tone_band - 1)),
        "actionability": F.when(s["action"], five).otherwise(two),
    }


def heuristic_rationale(email, candidate, sem: Column, cov: Column) -> Column:
    s = signals(email, candidate)
    py_bool = lambda c: F.when(c, F.lit("True")).otherwise(F.lit("False"))
    two = lambda c: F.rint(c * F.lit(100.0)) / F.lit(100.0)
    return F.format_string("heuristic: sem=%.2f, coverage=%.2f, len=%d, greeting=%s, action=%s",
                           two(sem), two(cov), s["words"], py_bool(s["greeting"]),
                           py_bool(s["action"]))


def rubric_scores(dims: dict[str, Column], rubric=DEFAULT_RUBRIC) -> list[Column]:
    """Scores in rubric order; a rubric name without a rule scores 3."""
    return [dims.get(d, F.lit(NEUTRAL)).cast("int").alias(d) for d in rubric]


def judge_average(rubric=DEFAULT_RUBRIC) -> tuple[Column, Column]:
    """``(judge_avg_1to5, judge_normalized)`` from rubric columns."""
    total = None
    for d in rubric:
        total = F.col(d) if total is None else total + F.col(d)
    avg = total.cast("double") / F.lit(float(len(rubric)))
    return avg, (avg - F.lit(1.0)) / F.lit(4.0)


def judge_prompt(email: str | Column, candidate: str | Column, reference: str | Column,
                 rubric=DEFAULT_RUBRIC) -> Column:
    """M7: the user message sent to an LLM judge."""
    keys = ", ".join(f'"{d}"' for d in rubric)
    return F.concat(F.lit(JUDGE_INTRO),
                    F.lit("CUSTOMER EMAIL:\n"), F.coalesce(_c(email), F.lit("")),
                    F.lit("\n\nREFERENCE REPLY:\n"), F.coalesce(_c(reference), F.lit("")),
                    F.lit("\n\nCANDIDATE REPLY:\n"), F.coalesce(_c(candidate), F.lit("")),
                    F.lit("\n\n"), F.lit(JUDGE_OUTRO % keys))


def _read_reply(span: str, rubric: tuple[str, ...]) -> tuple[bool, list[int], str]:
    """Scores and rationale of a span as Python's ``json``, ``float`` and ``str``
    read them: the last of equal keys wins, numbers may be texts, booleans or
    exponents, NaN counts as malformed; a score that can't be rounded, or broken
    JSON, spoils the reply."""
    try:
        found = json.loads(span)
        scores = []
        for name in rubric:
            try:
                scores.append(max(1, min(5, round(float(found.get(name, NEUTRAL))))))
            except (TypeError, ValueError):
                scores.append(NEUTRAL)
        text = str(found.get("rationale", ""))[:RATIONALE_MAX]
    except Exception:  # noqa: BLE001 - whatever is wrong, the reply is no verdict
        return False, [NEUTRAL] * len(rubric), ""
    return True, scores, text.encode("utf-8", "replace").decode()


def parse_judge_reply(reply: str | Column, rubric=DEFAULT_RUBRIC) -> dict[str, Column]:
    """M8: parse the first-``{``-to-last-``}`` span of a judge reply.

    Returns ``{"ok": parsed-or-no-braces, dim: score..., "rationale": ...}``.
    No braces -> every dimension 3 and an empty rationale. Braces whose text
    is not valid JSON -> ``ok`` is false and the caller falls back to the
    heuristic judge for that row, and so does an infinite score. A dimension
    that is missing or not a number scores 3; otherwise
    ``clamp(round_half_even(x), 1, 5)``. Spans are read in Arrow batches: the
    built-in parser rejects equal keys and NaN, and reads other numbers and
    texts than Python does."""
    names = tuple(rubric)
    kind = pa.struct([("ok", pa.bool_()), ("scores", pa.list_(pa.int32())),
                      ("rationale", pa.string())])

    @F.arrow_udf("ok boolean, scores array<int>, rationale string")
    def read(spans: pa.Array) -> pa.Array:
        rows = [(True, [NEUTRAL] * len(names), "") if not s else _read_reply(s, names)
                for s in spans.to_pylist()]
        return pa.array([dict(zip(("ok", "scores", "rationale"), r)) for r in rows], type=kind)

    found = read(F.regexp_extract(F.coalesce(_c(reply), F.lit("")), r"(?s)\{.*\}", 0))
    return {"ok": found["ok"], **{d: found["scores"][i] for i, d in enumerate(names)},
            "rationale": found["rationale"]}
