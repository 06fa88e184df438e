"""Make the URIs of payload files comparable, whoever reported them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Schemes that only mark a plain path. Others (s3a://bucket,
# hdfs://host) carry an authority that is part of the name and stays.
PATH_SCHEMES = "^(file|dbfs):/+"


def normalise_uri(uri: Column, encoded: bool) -> Column:
    """Plain path of a URI.

    ``encoded`` says whether the source percent-encodes paths, as the file
    metadata of a text or JSON scan does and a binary listing does not. A
    literal plus sign is protected, since decoding would read it as a blank;
    a text that is no valid encoding stays as it is.
    """
    path = F.regexp_replace(uri, PATH_SCHEMES, "/")
    if not encoded:
        return path
    protected = F.regexp_replace(path, r"\+", "%2B")
    return F.coalesce(F.try_url_decode(protected), path)
