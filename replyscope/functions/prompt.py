"""Few-shot prompt text and the grounded offline reply, as column
expressions over ranked cases."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Generation prompt texts and offline replies.
SYSTEM_PROMPT = (
    "You are a senior customer-support agent for an e-commerce company. "
    "Write the reply the company would send. Requirements:\n"
    "- Be warm, empathetic, and professional.\n"
    "- Be concise and specific; give the customer a clear next step.\n"
    "- Match the tone and policies shown in the examples.\n"
    "- NEVER invent policies, prices, or timelines not implied by the examples.\n"
    "- Output ONLY the reply body (no subject line, no meta commentary)."
)
PROMPT_HEADER = "Here are similar past tickets and the replies we sent:\n"
PROMPT_TASK = "\nNow write the best reply to this NEW customer email:\nCustomer: "
PROMPT_TAIL = "\nAgent reply:"
TOP_OPEN, TOP_CLOSE = "<<TOP_REPLY>>", "<<END_TOP_REPLY>>"
GROUNDED_PREFIX = ("Thanks for reaching out — I understand the concern and I'm "
                   "happy to help. ")
GENERIC_REPLY = ("Thanks for reaching out. I've reviewed your message and our team "
                 "will resolve this for you shortly. Please let me know if you need "
                 "anything else in the meantime.")
FAILURE_REPLY = ("Thank you for reaching out. We've received your message and "
                 "a support specialist will follow up shortly.")


def case_block(rank: Column, category: Column, score: Column, email: Column,
               reply: Column) -> Column:
    """One example block; rank 1's reply sits between the sentinels."""
    is_top = rank == 1
    return F.concat(
        F.lit("--- Example "), rank.cast("string"), F.lit(" (category: "), category,
        F.lit(", similarity: "), F.format_string("%.2f", F.rint(score * F.lit(100.0)) / F.lit(100.0)), F.lit(") ---\n"),
        F.lit("Customer: "), email, F.lit("\n"),
        F.lit("Agent reply: "), F.when(is_top, F.lit(TOP_OPEN)).otherwise(F.lit("")),
        reply, F.when(is_top, F.lit(TOP_CLOSE)).otherwise(F.lit("")), F.lit("\n"))


def user_prompt(blocks: Column, query_email: Column) -> Column:
    """G1: header, the example blocks in rank order, then the new email;
    blocks joined by newlines."""
    return F.concat_ws("\n", F.array_insert(
        F.array_append(blocks, F.concat(F.lit(PROMPT_TASK), query_email, F.lit(PROMPT_TAIL))),
        1, F.lit(PROMPT_HEADER)))


def grounded_reply(top_reply: Column) -> Column:
    """G2 from the rank-1 reply (null when there is no case)."""
    return F.when(top_reply.isNotNull(), F.concat(F.lit(GROUNDED_PREFIX), strip(top_reply))) \
        .otherwise(F.lit(GENERIC_REPLY))


def grounded_reply_from_prompt(prompt: Column) -> Column:
    """G2 from prompt text: the span between the sentinels, if both exist."""
    both = (F.instr(prompt, TOP_OPEN) > 0) & (F.instr(prompt, TOP_CLOSE) > 0)
    # Text after the first opening sentinel, up to the next closing one.
    first_after = F.substring(prompt, F.instr(prompt, TOP_OPEN) + len(TOP_OPEN), F.length(prompt))
    inner = F.substring_index(first_after, TOP_CLOSE, 1)
    return F.when(both, F.concat(F.lit(GROUNDED_PREFIX), strip(inner))).otherwise(F.lit(GENERIC_REPLY))
