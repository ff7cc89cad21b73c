"""Results of both engines in one form."""


def rows(frame):
    """Rows of a pandas frame in a form that both engines' results can be compared in, sorted; columns by name."""
    import pandas as pd

    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or v != v:
            return "NULL"
        return f"{float(v):.9g}" if isinstance(v, (int, float)) or hasattr(v, "dtype") and v.dtype.kind in "iuf" else str(v)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(map(plain, r)) for r in frame.itertuples(index=False))
