"""Arrow-batched NFC normalisation (the only text step with no built-in)."""

import unicodedata

import pandas as pd
from pyspark.sql.functions import pandas_udf


@pandas_udf("string")
def nfc_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda t: unicodedata.normalize("NFC", t) if isinstance(t, str) else t)
