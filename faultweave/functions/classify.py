"""Classification of messages by ordered patterns; the first match wins, the second layer counts only where the first has none."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "unknown"

#: First layer (fixed values): category, error type, needs a person, data was acquired, pattern.
TRANSPORT = (
    ("connection_timeout", "connection", False, False, r"Connection timed out"),
    ("max_retries", "connection", False, False, r"error: max-retries exceeded"),
    ("connection_timeout", "connection", False, False, r"(?i)Connection to (\d{1,3}(?:\.\d{1,3}){3}) port (\d+) timed out"),
    ("session_timeout", "connection", False, False, r"Timeout, server \d{1,3}(?:\.\d{1,3}){3} not responding"),
    ("partial_transfer_timeout", "connection", False, False, r"curl: \(28\) Operation timed out after \d+ milliseconds with \d+(?: out of \d+)? bytes received"),
    ("connection_timeout", "connection", False, False, r"curl: \(28\) (?:Connection|Operation) timed out|curl: \(28\) Failed to connect to .+? port \d+ after \d+ ms|curl: \(28\) Connection timeout after \d+ ms"),
    ("connection_reset", "connection", False, False, r"curl: \(56\) Recv failure: Connection reset by peer"),
    ("http2_cancel", "connection", False, False, r"curl: \(92\) HTTP\/2 stream \d+ was not closed cleanly"),
    ("host_unreachable", "connection", False, False, r"(?:ssh|scp|rsync): connect to host \d{1,3}(?:\.\d{1,3}){3} port \d+: No route to host"),
    ("connection_refused", "connection", False, False, r"(?:ssh|scp|rsync): connect to host \d{1,3}(?:\.\d{1,3}){3} port \d+: Connection refused"),
    ("host_key_changed", "key", True, False, r"(?i)remote host identification has changed"),
    ("host_key_new", "key", True, False, r"Warning:\sPermanently\sadded\s'\d+\.\d+\.\d+\.\d+'.+to\sthe\slist\sof\sknown\shosts"),
    ("key_exchange", "key", True, False, r"(?i)Unable to negotiate with \d+\.\d+\.\d+\.\d+.+"),
    ("credentials", "credentials", True, False, r"(?i)Login failed|Login incorrect"),
    ("credentials", "credentials", True, False, r"Permission denied \(publickey"),
    ("connection_reset", "connection", False, False, r"rsync: connection unexpectedly closed|Broken pipe"),
    ("rsync_io_timeout", "connection", False, False, r"rsync error: timeout in data send\/receive"),
    ("rsync_protocol_error", "connection", False, False, r"error in rsync protocol data stream"),
    ("permission_denied_partial", "file", True, True, r"mget: Access failed: Permission denied"),
    ("file_missing_partial", "file", False, True, r"mget: Access failed: No such file"),
    ("file_missing_partial", "file", False, True, r"mget: Access failed: 550"),
    ("file_missing_partial", "file", False, True, r"(?i)mget: \S+: no files found"),
    ("mirror_file_skipped", "file", False, True, r"mirror: \S+: |mirror: Access failed: 550"),
    ("rsync_source_missing", "file", False, False, r"rsync: \[sender\] link_stat .+ failed: No such file or directory"),
    ("rsync_partial", "file", False, True, r"rsync error: some files\/attrs were not transferred"),
    ("file_missing", "file", True, False, r"(?i)(scp|tar): No match"),
)

#: Second layer (fixed values), in the same form.
ENGINE = (
    ("tunnel_not_found", "config", True, False, r"^NO TUNNEL FOUND\z"),
    ("config_missing", "config", True, False, r"^missing (host_ip|credentials_group|acquisition_script)\b"),
    ("config_missing", "config", True, False, r"^JOB HALTED -> NON-CONFORMANT config\z"),
    ("credential_decrypt_error", "credentials", True, False, r"Invalid authentication tag length"),
    ("job_halted", "halt", False, False, r"^JOB HALTED"),
    ("input_file_missing", "file", False, False, r"^File [Nn]ot [Pp]resent\z|^File not found in directory: |^no such file or directory\z|ENOENT: no such file or directory, (stat|scan|open|read)"),
    ("unhandled_type_error", "crash", False, False, r"TypeError: Cannot read properties of (null|undefined)"),
    ("datetime_parse_null", "quality", False, False, r"^datetime object null\z"),
    ("no_new_data", "status", False, False, r"^No new (file data\. Delta: -?\d+|files detected)\z"),
    ("counter_reset_reread", "status", False, False, r"^Delta is negative value: .*Reading entire file\."),
)


def _first_match(text: Column, rules: tuple, value) -> Column:
    return F.coalesce(*(F.when(text.rlike(r[4]), value(r)) for r in rules))


def classify(text: Column) -> Column:
    """Struct of category, error_type, manual_intervention and successful_acquisition of a raw (not normalized) message."""

    def struct(r: tuple) -> Column:
        return F.struct(F.lit(r[0]).alias("category"), F.lit(r[1]).alias("error_type"), F.lit(r[2]).alias("manual_intervention"), F.lit(r[3]).alias("successful_acquisition"))

    return F.coalesce(_first_match(text, TRANSPORT + ENGINE, struct), struct((UNKNOWN, "", False, False)))


def category(text: Column) -> Column:
    return F.coalesce(_first_match(text, TRANSPORT + ENGINE, lambda r: F.lit(r[0])), F.lit(UNKNOWN))


def layer(text: Column) -> Column:
    """Which layer a message falls in: transport, engine or none."""
    return F.coalesce(_first_match(text, TRANSPORT, lambda r: F.lit("transport")), _first_match(text, ENGINE, lambda r: F.lit("engine")), F.lit("none"))


def taxonomy(spark: SparkSession) -> DataFrame:
    """The categories as a small table: category, error_type, manual_intervention, successful_acquisition; first entries win."""
    rows = {r[0]: r[:4] for r in reversed(list(chain(TRANSPORT, ENGINE)))}
    return spark.createDataFrame(sorted(rows.values()), "category string, error_type string, manual_intervention boolean, successful_acquisition boolean")
