"""The physical plan of a DataFrame as text."""

import contextlib
import io


def plan_of(df, mode: str = "simple") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()
