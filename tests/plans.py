"""Physical plan text through the public ``DataFrame.explain``."""

import contextlib
import io


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()
