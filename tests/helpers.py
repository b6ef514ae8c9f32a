import contextlib
import io


def plan_text(df, mode="formatted"):
    """The text ``df.explain(mode)`` prints (public API, captured)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
