"""Per-account sequence number of transactions (the fact table build).

``txn_seq_in_account`` = ``row_number()`` over the account ordered by
``txn_ts`` and then ``txn_id`` (the tie-breaker makes it deterministic);
see ``ranking.number_within`` for how large accounts are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlake.operators.ranking import number_within

SEQ = "txn_seq_in_account"


def build_fact_transaction(clean: DataFrame) -> DataFrame:
    return number_within(clean, "account_id", ["txn_ts", "txn_id"], SEQ)
