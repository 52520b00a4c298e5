"""Names of the technical columns that travel with every table."""

from pyspark.sql import types as T

# Label of the delivery a row belongs to.
LEVERING = "levering"
# Position of a row inside its delivery: split offset, row in the split, part of the row. Orders "first" and "last".
VOLGORDE = "_volgorde"
VOLGORDE_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in ("blok", "regel", "deel")])
# Date notation of the delivery (iso, compact or dutch); present between reading and decoding only.
DATUMFORMAAT = "_datumformaat"
# Person a count-date row belongs to, taken from its parent element.
OUDER_PREFIX = "_ouder_"
PERSOON = "_persoon_id"
BRON = "_bron"

HIDDEN = (VOLGORDE, DATUMFORMAAT)
