"""Connection pool keys of URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)"
HOST_PORT = r"^(\[[^\]]*\]|[^:\[\]]*)(?::(.*))?$"


def _parts(url: Column) -> tuple[Column, Column, Column]:
    clean = F.regexp_replace(url, r"^[\x00-\x20]+|[\x00-\x20]+$|[\t\r\n]", "")
    scheme = F.lower(F.regexp_extract(clean, SCHEME, 1))
    authority = F.regexp_replace(F.regexp_extract(clean, SCHEME, 2), r"^.*@", "")
    return scheme, F.lower(F.regexp_replace(F.regexp_extract(authority, HOST_PORT, 1), r"[\[\]]", "")), F.regexp_extract(authority, HOST_PORT, 2)


def host(url: Column) -> Column:
    """Lower-case host of a URL that has a key, else NULL."""
    return F.when(pool_key(url).isNotNull(), _parts(url)[1])


def pool_key(url: Column) -> Column:
    """scheme://host, and :port where it isn't the scheme's own; NULL for what can't be fetched."""
    scheme, name, port = _parts(url)
    number = port.try_cast("long")
    own = ((scheme == "http") & (number == 80)) | ((scheme == "https") & (number == 443))
    good = (scheme != "") & (name != "") & ((port == "") | (port.rlike(r"^\d+$") & (number <= 65535)))
    tail = F.when((port == "") | own, "").otherwise(F.concat(F.lit(":"), number.cast("string")))
    return F.when(good, F.concat(scheme, F.lit("://"), name, tail))
