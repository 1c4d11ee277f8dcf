import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabwatch.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 8, app_name="tabwatch-tests")
    yield s


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)


def telco_rows(n: int = 200, seed: int = 7) -> pd.DataFrame:
    """Synthetic customer table with the raw schema (values by rule, seeded)."""
    from tabwatch.sources import telco as T

    r = np.random.default_rng(seed)
    out = {"customerID": [f"C{i:05d}" for i in range(n)]}
    for c in T.CATEGORICAL:
        dom = T._DOMAINS[c]
        out[c] = [dom[i] for i in r.integers(0, len(dom), n)]
    out["SeniorCitizen"] = r.integers(0, 2, n).astype("int32")
    tenure = r.integers(0, 73, n).astype("int32")
    out["tenure"] = tenure
    monthly = np.round(r.uniform(18.0, 118.0, n), 2)
    out["MonthlyCharges"] = monthly
    out["TotalCharges"] = np.round(monthly * np.maximum(tenure, 1), 2)
    logit = -1.0 + 1.5 * (np.array(out["Contract"]) == "Month-to-month") - 0.03 * tenure \
        + 0.01 * (monthly - 60)
    out["Churn"] = np.where(r.uniform(size=n) < 1 / (1 + np.exp(-logit)), "Yes", "No")
    return pd.DataFrame(out)[T.RAW_ORDER]
