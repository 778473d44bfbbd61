"""What a physical plan contains."""

from __future__ import annotations

import io
from contextlib import redirect_stdout


def plan(df) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def final_plan(df) -> str:
    """The plan after a run, with the choices made on the way."""
    df.collect()
    text = plan(df)
    assert "isFinalPlan=true" in text
    return text
