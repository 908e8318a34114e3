"""Small invoice tables for tests."""

import numpy as np
import pandas as pd

from remitlens.contracts import MEAN_MEASURES, SUM_MEASURES

MEASURES = sorted({*SUM_MEASURES.values(), *MEAN_MEASURES.values(), "expected_85em"})
IDS = ["year", "week", "payer", "group_em", "group_em2", "invoice_number", "cpt_code"]
SCHEMA = (
    "row_id bigint, year int, week int, payer string, group_em string, group_em2 string, invoice_number string, cpt_code string, "
    + ", ".join(f"{m} double" for m in MEASURES)
)


def random_lines(n=600, seed=0, hot=False):
    """Random lines with missing payers and measures, repeated codes, and invoices that span groups."""
    rng = np.random.default_rng(seed)
    invoice = np.where(rng.random(n) < (0.4 if hot else 0), "hot", np.char.add("i", rng.integers(0, n // 4, n).astype(str)))
    frame = pd.DataFrame(
        {
            "row_id": np.arange(n),
            "year": rng.integers(2023, 2025, n),
            "week": rng.integers(1, 4, n),
            "payer": rng.choice(["A", "B", None], n, p=[0.5, 0.4, 0.1]),
            "group_em": rng.choice(["New E/M Code", "Other"], n),
            "group_em2": rng.choice(["s", None], n, p=[0.9, 0.1]),
            "invoice_number": invoice,
            "cpt_code": rng.choice(["10", "11", " 12", "13"], n),
        }
    )
    for i, m in enumerate(MEASURES):
        values = rng.integers(-50 if i % 3 == 0 else 0, 200, n).astype(float)
        frame[m] = np.where(rng.random(n) < 0.15, np.nan, values)
    return frame


def to_spark(spark, frame, schema=SCHEMA):
    rows = [tuple(None if pd.isna(v) else (v.item() if hasattr(v, "item") else v) for v in r) for r in frame.itertuples(index=False)]
    return spark.createDataFrame(rows, schema)


def plain(df, keys, digits=9):
    """Rows as {key: {column: value}} with doubles rounded."""
    out = {}
    for row in df.collect():
        record = row.asDict()
        key = tuple(record.pop(k) for k in keys)
        assert key not in out, f"repeated key {key}"
        out[key] = {c: round(v, digits) if isinstance(v, float) else v for c, v in record.items()}
    return out


def text_key(v):
    return "nan" if v is None or (isinstance(v, float) and np.isnan(v)) else str(v)


def with_keys(frame):
    """Keys built row by row in pandas."""
    frame = frame.copy()
    sets = frame.groupby("invoice_number").cpt_code.apply(lambda c: str(sorted({x.strip() for x in c})))
    frame["cpt_list_str"] = frame.invoice_number.map(sets)
    frame["benchmark_key"] = [
        "|".join([text_key(r.payer), text_key(r.group_em), text_key(r.group_em2), r.cpt_list_str]) for r in frame.itertuples()
    ]
    return frame
