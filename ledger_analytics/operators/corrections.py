"""Netting by retraction (A1, F3, Q10): a file that is sent again takes back
what it gave and gives what it has now.

The state is the net amount and the number of lines per (registration, year,
quarter), whatever its sign, as :func:`~ledger_analytics.operators.consolidate.net_lines`
makes it.  The change set of a resent file has, per key, the new lines' sum
less the old ones'.  Only the keys in it are netted, joined with the registry
and written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import DEFAULT_DATE_FORMATS
from .consolidate import attach_registry, split_dates

KEYS = ("RegistroANS", "Ano", "Trimestre")
#: changed keys that are sent to all tasks at once; more of them are joined by exchange
SENT_KEYS = 1_000_000


def net_changes(old_lines: DataFrame, new_lines: DataFrame, formats=DEFAULT_DATE_FORMATS) -> DataFrame:
    """``RegistroANS, Ano, Trimestre, net, n_lines``: what replacing some
    normalised lines by others adds to each key (amounts and counts may be
    negative).  Keys whose sum and count stay the same are not in it; lines
    without a valid date count nowhere."""
    signed = [split_dates(lines, formats)[0].select(F.col("REGISTRO_OPERADORA").alias("RegistroANS"), "Ano", "Trimestre",
                                                   (F.col("VALOR_DESPESAS") * sign).alias("v"), F.lit(sign).alias("one"))
              for lines, sign in ((old_lines, -1), (new_lines, 1))]
    return (signed[0].unionByName(signed[1]).groupBy(*KEYS)
            .agg(F.sum("v").cast("decimal(28,2)").alias("net"), F.sum("one").alias("n_lines"))
            .where("net <> 0 OR n_lines <> 0"))


def _same_key(left: str, right: str):
    return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in KEYS]


def _keys_of(changes: DataFrame, sent: int) -> DataFrame:
    """The changed keys, to be sent to the tasks of the larger table if they are few."""
    keys = changes.select(*KEYS)
    return F.broadcast(keys) if keys.count() <= sent else keys


def untouched(rows: DataFrame, changes: DataFrame, sent: int = SENT_KEYS) -> DataFrame:
    """The rows of a table with :data:`KEYS` that no change touches; they are
    not exchanged as long as the changed keys are at most ``sent``."""
    return rows.alias("r").join(_keys_of(changes, sent).alias("c"), _same_key("r", "c"), "left_anti")


def changed_nets(nets: DataFrame, changes: DataFrame, sent: int = SENT_KEYS) -> DataFrame:
    """The touched keys' nets after the changes; a key without lines is gone."""
    touched = nets.alias("r").join(_keys_of(changes, sent).alias("c"), _same_key("r", "c"), "left_semi")
    return (touched.select(*KEYS, "net", "n_lines").unionByName(changes.select(*KEYS, "net", "n_lines")).groupBy(*KEYS)
            .agg(F.sum("net").cast("decimal(28,2)").alias("net"), F.sum("n_lines").alias("n_lines")).where("n_lines <> 0"))


def consolidated_after(consolidated: DataFrame, nets: DataFrame, changes: DataFrame, registry: DataFrame,
                       on_unmatched: str = "drop", sent: int = SENT_KEYS) -> DataFrame:
    """Consolidated rows after a change set: the touched keys' rows anew, all
    others as they are."""
    again = attach_registry(changed_nets(nets, changes, sent), registry, on_unmatched)
    return untouched(consolidated, changes, sent).unionByName(again)
