"""Fixed query parameters used by the registered queries (the reference's config knobs)."""

# train/hold-out split and forecast horizon for the driver data
# (ship dates run 1995-01-02 .. 2001-11-04 at every scale factor).
TRAIN_END = "2000-06-30"
HORIZON_MONTHS = 15
LAGS = (12,)
WINDOWS = (6,)
ROUND = 4          # places for computed doubles in query outputs (hash-stable)
# Partition label of the sink's round trip (cutoff and horizon themselves come from the panel).
CUTOFF_LABEL = "2001-11"
# Region codes searched in campaign names, the (brand, region)
# pairs kept for marketing features, and the pivot values of ``source``.
REGIONS = ("ASIA", "EUROPE")
BRAND_REGION_PAIRS = (("BUILDING", "ASIA"), ("MACHINERY", "EUROPE"), ("AUTOMOBILE", "ASIA"),
                      ("HOUSEHOLD", "EUROPE"), ("FURNITURE", "ASIA"))
SOURCES = ("high", "low", "medium", "not specified", "urgent")
