"""Hosting-network test on the name of an autonomous system's operator."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark an operator as a data centre.
HOSTING_KEYWORDS = (
    "hosting", "host", "datacenter", "data center", "dedicated", "server", "cloud", "vps", "colo", "ovh",
    "hetzner", "digitalocean", "linode", "vultr", "contabo", "scaleway", "leaseweb", "m247", "choopa", "amazon",
    "aws", "google llc", "microsoft", "azure", "oracle", "alibaba", "tencent", "packet", "equinix", "cogent",
    "netcup", "aeza", "vdsina", "timeweb", "selectel", "firstbyte", "ihor", "serverius", "worldstream",
    "clouvider",
)


def hosting_flag(org: str, keywords: Iterable[str] | None = None) -> Column:
    """1 when the lower-cased operator name contains any keyword, else 0.

    ``org`` is SQL text naming the value.
    """
    words = [w.lower().replace("\\", "\\\\").replace("'", "\\'") for w in (keywords or HOSTING_KEYWORDS)]
    tests = " OR ".join(f"contains(lower({org}), '{w}')" for w in words)
    return F.expr(f"CASE WHEN {org} <> '' AND ({tests}) THEN 1 ELSE 0 END")
