"""Run a caller-supplied completion function over a table.

``complete(system, user, temperature, max_tokens) -> str`` answers one row at a
time; a ``ModelRunner`` (``operators.runner``) takes batches of user prompts and
knows set-up, concurrency, retries and a journal. A failing row gets a fallback
text, its error message and the backend that actually produced it; the run goes
on."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runner import ModelRunner, run_model

Completer = Callable[[str, str, float, int], str]


def as_runner(complete: Completer | ModelRunner, system: str, temperature: float,
              max_tokens: int) -> ModelRunner:
    if isinstance(complete, ModelRunner):
        return complete
    return ModelRunner(lambda _, users: [complete(system, u, temperature, max_tokens)
                                         for u in users])


def complete_table(df: DataFrame, key_col: str, system: str, prompt_col: str,
                   complete: Completer | ModelRunner, backend: str, temperature: float,
                   max_tokens: int, fallback_text: str | None,
                   fallback_backend: str = "fallback") -> DataFrame:
    """Output ``key, completion, backend, error``. ``fallback_text=None``
    leaves ``completion`` null on failure (the caller decides). A runner's
    ``call`` gets the user prompts; its client knows the rest."""
    runner = as_runner(complete, system, temperature, max_tokens)
    failed = F.col("error").isNotNull()
    return run_model(df, key_col, prompt_col, runner).select(
        key_col,
        F.when(failed, F.lit(fallback_text)).otherwise(F.col("value")).alias("completion"),
        F.when(failed, F.lit(fallback_backend)).otherwise(F.lit(backend)).alias("backend"),
        "error")


def echo_completer(system: str, user: str, temperature: float, max_tokens: int) -> str:
    """A deterministic stand-in model for tests: echoes the last prompt line."""
    lines = [ln for ln in user.splitlines() if ln.strip()]
    return lines[-1] if lines else ""
