"""Temporal URL list join, as DataFrame expressions.

Dated list entries (list, host, date, listed or unlisted) become validity
intervals; every capture is judged by the entries active on its fetch date, for
its host or any parent domain of it.

Only distinct hosts meet the lists by domain, however many captures a host or a
domain like ``com`` has: (host, listed domain) pairs come out, one per host and
listed parent, and give every host its own intervals. Distinct (host, date) pairs
are then judged as of their date against their host's intervals, and the verdicts
joined back by (host, date).

Defined results: hosts and entries are compared in lower case without trailing
dots, entries also without a leading ``.`` or ``*.``; an IP address (IPv6 in
brackets) has no parent domains; of entries for one list, host and date, listing
wins; intervals start on their date and end before the next entry's; a capture
with a NULL or unreadable URL or a NULL date matches nothing; repeated captures
each get the verdict; entries without list, host or date are void; other columns
are ignored; without entries or captures nothing is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Scheme, optional user info, host (or IPv6 in brackets) up to port, path, query
#: or fragment.
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:\[]+)"
_IP = r"^([0-9]{1,3}([.][0-9]{1,3}){3}|\[.*\])$"


def _plain(host: Column) -> Column:
    """Lower case, without trailing dots; NULL if nothing is left."""
    host = F.regexp_replace(F.lower(host), r"\.+$", "")
    return F.when(host != "", host)


def host_of(url: Column) -> Column:
    """Host of a URL, NULL where there is none."""
    return _plain(F.regexp_extract(url, HOST, 1))


def parent_domains(host: Column) -> Column:
    """The host and each domain above it; an IP address stands alone."""
    labels = F.split(host, r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host.rlike(_IP), F.array(host)).otherwise(above)


def validity(entries: DataFrame) -> DataFrame:
    """(list_name, host, valid_from, valid_to) from dated entries with columns
    list_name, host, dated and listed (boolean); valid_to is NULL while open."""
    named = entries.withColumn("host", _plain(F.regexp_replace(F.trim("host"), r"^(\*?\.)+", "")))
    daily = (named.where("list_name is not null and host is not null and dated is not null")
             .groupBy("list_name", "host", "dated")
             .agg(F.bool_or(F.coalesce(F.col("listed"), F.lit(False))).alias("listed")))
    following = Window.partitionBy("list_name", "host").orderBy("dated")
    return (daily.withColumn("valid_to", F.lead("dated").over(following)).where("listed")
            .select("list_name", "host", F.col("dated").alias("valid_from"), "valid_to"))


def judge_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, host, fetched_on, n_active (entries active then), first_list and
    blocked, one row per capture (page_id, url, fetched_on)."""
    rows = captures.select("page_id", host_of(F.col("url")).alias("host"), "fetched_on")
    visits = rows.where("host is not null and fetched_on is not null") \
        .select("host", "fetched_on").distinct()
    hosts = visits.select("host").distinct().select(
        "host", F.explode(parent_domains(F.col("host"))).alias("domain"))
    spans = validity(entries).withColumnRenamed("host", "domain")
    own = hosts.join(spans, "domain").select(F.col("host").alias("_host"), "list_name",
                                             "valid_from", "valid_to")
    active = visits.join(own, (F.col("host") == F.col("_host"))
                         & (F.col("fetched_on") >= F.col("valid_from"))
                         & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to"))))
    verdicts = active.groupBy("host", "fetched_on").agg(
        F.count(F.lit(1)).alias("n_active"), F.min("list_name").alias("first_list"))
    return (rows.join(verdicts, ["host", "fetched_on"], "left")
            .select("page_id", "host", "fetched_on",
                    F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), "first_list",
                    F.col("n_active").isNotNull().alias("blocked")))
