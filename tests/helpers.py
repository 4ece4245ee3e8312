import io
from contextlib import redirect_stdout

import pandas as pd


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def comparable(frame):
    """Rows of a pandas frame as sorted tuples of text, columns by name."""
    frame = frame[sorted(frame.columns)]
    kept = []
    for values in frame.itertuples(index=False):
        kept.append(
            tuple(
                "<null>" if pd.isna(v) else repr(float(v)) if isinstance(v, float) else str(v)
                for v in values
            )
        )
    return sorted(kept)
