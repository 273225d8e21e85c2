"""Helpers that look at physical plans."""

import contextlib
import io


def physical_plan(frame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain()
    return out.getvalue()
