"""A second way to the evidence of audited cases, apart from the screen it checks.

Nothing here calls the screen's operators: the evidence is derived in SQL from raw transfers, raw
transactions and prices, by other formulas. Movement is the sum of what was received on balance,
not half of all nets; gaps come from counts per second and the distinct seconds, not from a carried
row; quartiles from running counts; and every threshold is compared by cross-multiplied integers, not
by rounded shares. Only the published thresholds are common to both.

The cases are few, and a window here sorts the counted seconds of one case and token.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tallyproof.operators import signals

_GROUPS = """
WITH touched AS (
  SELECT DISTINCT tx_hash FROM {transfers} t JOIN {cases} c
    ON c.address = t.sender OR c.address = t.receiver
  WHERE t.block_time >= {start} AND t.block_time < {end}),
moved AS (
  SELECT t.* FROM {transfers} t LEFT SEMI JOIN touched ON t.tx_hash = touched.tx_hash
  WHERE t.block_time >= {start} AND t.block_time < {end}),
balance AS (
  SELECT tx_hash, token, side.address, SUM(side.amount) AS amount,
    MAX(unix_seconds(CAST(block_time AS TIMESTAMP))) AS second, MAX(block_date) AS day
  FROM (SELECT *, explode(array(
      named_struct('address', receiver, 'amount', CAST(value AS DECIMAL(38,0))),
      named_struct('address', sender, 'amount', -CAST(value AS DECIMAL(38,0))))) AS side FROM moved)
  GROUP BY tx_hash, token, side.address),
received AS (
  SELECT tx_hash, SUM(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS amount
  FROM balance GROUP BY tx_hash),
paid AS (
  SELECT x.tx_hash, CAST(x.gas_used AS DECIMAL(19,0)) * CAST(x.gas_price AS DECIMAL(19,0))
    * CASE WHEN CAST(p.price AS DECIMAL(28,8)) = p.price THEN CAST(CAST(p.price AS DECIMAL(28,8)) * 100000000 AS DECIMAL(28,0))
      ELSE CAST(raise_error('a gas price has more than eight places') AS DECIMAL(28,0)) END AS units
  FROM {transactions} x JOIN {prices} p
    ON p.asset = {asset} AND p.bucket = date_trunc('HOUR', x.block_time)
  WHERE x.block_time >= {start} AND x.block_time < {end}),
fired AS (
  SELECT r.tx_hash FROM received r JOIN paid f ON f.tx_hash = r.tx_hash
  WHERE f.units >= r.amount * CAST(100000000000000000000 AS DECIMAL(21,0))),
own AS (SELECT b.* FROM balance b LEFT SEMI JOIN {cases} c ON b.address = c.address WHERE amount <> 0),
days AS (SELECT address, token, day, COUNT(*) AS n FROM own GROUP BY address, token, day),
pairs AS (
  SELECT address, token, SUM(n) AS n, MAX(n) AS top, SUM(n * n) AS squares
  FROM days GROUP BY address, token
  HAVING SUM(n) >= {min_groups} AND COUNT(*) >= {min_days})
"""

_TEMPORAL = """,
seconds AS (
  SELECT o.address, o.token, o.second, COUNT(*) AS n
  FROM own o LEFT SEMI JOIN pairs p ON o.address = p.address AND o.token = p.token
  GROUP BY o.address, o.token, o.second),
steps AS (
  SELECT address, token, second - LAG(second) OVER (PARTITION BY address, token ORDER BY second) AS gap,
    1 AS n FROM seconds
  UNION ALL SELECT address, token, 0, n - 1 FROM seconds WHERE n > 1),
gaps AS (
  SELECT address, token, gap, SUM(n) AS n FROM steps WHERE gap IS NOT NULL GROUP BY address, token, gap),
running AS (
  SELECT *, SUM(n) OVER (PARTITION BY address, token ORDER BY gap) AS upto,
    SUM(n) OVER (PARTITION BY address, token) AS total FROM gaps),
spread AS (
  SELECT address, token, MAX(total) AS n, SUM(CAST(gap * n AS DECIMAL(38,0))) AS s,
    SUM(CAST(gap AS DECIMAL(18,0)) * gap * n) AS q, SUM(CASE WHEN gap = 0 THEN n ELSE 0 END) AS zeros,
    {quarters}
  FROM running GROUP BY address, token),
branches AS (
  SELECT p.address,
    COALESCE(q2 > 0 AND (g.n * g.q - g.s * g.s) * 100000000 < CAST({cv} + 1 AS DECIMAL(10,0)) * ({cv} + 1) * g.s * g.s
      AND (q3 - q1) * 10000 < ({iqr} + 1) * q2, false) AS regular,
    COALESCE(g.zeros * 10000 >= {zero_gap} * g.n, false) AS burst,
    p.top * 10000 >= {day_share} * p.n AND p.squares * 10000 >= {hhi} * p.n * p.n AS single
  FROM pairs p LEFT JOIN spread g ON g.address = p.address AND g.token = p.token),
temporal AS (
  SELECT address, BOOL_OR(regular OR burst OR single) AS temporal FROM branches GROUP BY address)
"""

_REST = """,
partners AS (
  SELECT s.address, s.token, s.partner, COUNT(DISTINCT s.tx_hash) AS n FROM (
    SELECT receiver AS address, token, sender AS partner, tx_hash FROM moved
    UNION ALL SELECT sender, token, receiver, tx_hash FROM moved) s
  LEFT SEMI JOIN pairs p ON p.address = s.address AND p.token = s.token
  GROUP BY s.address, s.token, s.partner),
richness AS (
  SELECT address, BOOL_OR(few) AS richness FROM (
    SELECT address, token, COUNT(*) <= {partners} AND MAX(n) * 10000 >= {top_share} * SUM(n) AS few
    FROM partners GROUP BY address, token) GROUP BY address),
economic AS (
  SELECT o.address, COUNT(*) AS nonzero_groups, COUNT(f.tx_hash) AS fired_groups
  FROM own o LEFT SEMI JOIN pairs p ON o.address = p.address AND o.token = p.token
  LEFT JOIN fired f ON f.tx_hash = o.tx_hash GROUP BY o.address)
SELECT e.address, t.temporal, COALESCE(r.richness, false) AS richness,
  e.fired_groups > 0 AND e.fired_groups * 10000 >= {gate} * e.nonzero_groups AS economic,
  e.nonzero_groups, e.fired_groups
FROM economic e JOIN temporal t ON t.address = e.address LEFT JOIN richness r ON r.address = e.address
"""


def _quarter(k: int) -> str:
    """The k-th quartile in quarters: its two neighbours, weighted by what is left of the rank."""
    low = f"MIN(CASE WHEN upto > (total - 1) * {k} DIV 4 THEN gap END)"
    high = f"MIN(CASE WHEN upto > LEAST((total - 1) * {k} DIV 4 + 1, total - 1) THEN gap END)"
    rest = f"(MAX(total) - 1) * {k} % 4"
    return f"{low} * (4 - {rest}) + {high} * ({rest}) AS q{k}"


def case_evidence(
    cases: DataFrame,
    transfers: DataFrame,
    transactions: DataFrame,
    prices: DataFrame,
    window: tuple[datetime, datetime],
    gate_bps: int,
    min_groups: int,
    min_days: int,
    asset: str,
) -> DataFrame:
    """Temporal, counterparty and economic evidence of each address in ``cases``."""
    text = (_GROUPS + _TEMPORAL + _REST).replace("{quarters}", ",\n    ".join(map(_quarter, (1, 2, 3))))
    for name, at in zip(("{start}", "{end}"), window, strict=True):
        text = text.replace(name, f"TIMESTAMP '{at.isoformat(sep=' ')}'")
    return cases.sparkSession.sql(
        text, cases=cases.select("address").distinct(), transfers=transfers, transactions=transactions,
        prices=prices, asset=asset, min_groups=min_groups, min_days=min_days,
        gate=gate_bps, cv=signals.MAX_CV, iqr=signals.MAX_IQR_MEDIAN, zero_gap=signals.MIN_ZERO_GAP,
        day_share=signals.MIN_DAY_SHARE, hhi=signals.MIN_HHI, partners=signals.MAX_COUNTERPARTIES,
        top_share=signals.MIN_TOP_SHARE,
    )
