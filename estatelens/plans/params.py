"""Parameters of the registered queries (run dates, city subsets), shared by Spark and the oracle."""

import datetime as dt

# run date of the gate batches and of the as-of-dependent models
BATCH_DATE = "2024-01-31"
AS_OF = dt.date(2024, 1, 31)
# the incremental replay: target built from scrapes before this day, then merged with the rest
INCREMENTAL_CUTOFF = "2024-01-20"

# snapshot runs of the partitioned history
SNAPSHOT_DAYS = tuple(AS_OF - dt.timedelta(days=n) for n in (12, 8, 3, 0))
# a day spine that starts too late for some published days
SPINE_FROM = dt.date(2024, 1, 10)

# the gate run restricted to a city subset
SUBSET_CITIES = ("nation-0-africa", "nation-5-africa", "nation-7-asia", "nation-10-africa", "nation-14-middle-east",
                 "nation-20-africa", "nation-21-america", "nation-24-middle-east")

# the listing whose version history the history report shows
HISTORY_LISTING_ID = 8

# collection time stamped on normalised items (UTC wall clock)
COLLECTED_AT = "2024-01-31 03:00:00"
