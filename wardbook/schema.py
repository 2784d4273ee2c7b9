"""Raw request layout and the column groups the cleaning rules work on."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns, names and order of the raw request table.
RAW_COLUMNS = [
    "unique_key",
    "created_date",
    "closed_date",
    "resolution_action_updated_date",
    "agency",
    "agency_name",
    "complaint_type",
    "descriptor",
    "descriptor_2",
    "status",
    "resolution_description",
    "open_data_channel_type",
    "incident_address",
    "street_name",
    "cross_street_1",
    "cross_street_2",
    "intersection_street_1",
    "intersection_street_2",
    "landmark",
    "city",
    "borough",
    "incident_zip",
    "community_board",
    "council_district",
    "police_precinct",
    "park_borough",
    "park_facility_name",
    "taxi_pick_up_location",
    "bbl",
    "x_coordinate_state_plane",
    "y_coordinate_state_plane",
    "latitude",
    "longitude",
    "location",
    "raw_json",
]

# How each group of raw columns is cleaned.
TIMESTAMP_COLUMNS = ["created_date", "closed_date", "resolution_action_updated_date"]
CASE_KEPT_COLUMNS = [
    "resolution_description",
    "incident_zip",
    "council_district",
    "taxi_pick_up_location",
    "bbl",
    "x_coordinate_state_plane",
    "y_coordinate_state_plane",
]
COORDINATE_COLUMNS = ["latitude", "longitude"]

UPPER_COLUMNS = [
    "agency",
    "agency_name",
    "complaint_type",
    "descriptor",
    "descriptor_2",
    "status",
    "open_data_channel_type",
    "incident_address",
    "street_name",
    "cross_street_1",
    "cross_street_2",
    "intersection_street_1",
    "intersection_street_2",
    "landmark",
    "city",
    "community_board",
    "police_precinct",
    "park_borough",
    "park_facility_name",
]

# What a missing borough or complaint type is called.
UNSPECIFIED = "UNSPECIFIED"

# Payload fields as they arrive: everything is text until it is typed.
PAYLOAD_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in RAW_COLUMNS if c != "raw_json"]
)

RAW_SCHEMA = T.StructType(
    [
        T.StructField(c, T.TimestampNTZType() if c in TIMESTAMP_COLUMNS else T.StringType())
        for c in RAW_COLUMNS
    ]
)

# Where a row came from: ingest run, page within the run. Stored beside the raw
# columns so that an upsert can tell which of two versions arrived later.
ARRIVAL_COLUMNS = ["run_no", "page_no"]
PARTITION_COLUMN = "created_day"

STORED_SCHEMA = T.StructType(
    [
        *RAW_SCHEMA.fields,
        *[T.StructField(c, T.LongType()) for c in ARRIVAL_COLUMNS],
        T.StructField(PARTITION_COLUMN, T.DateType()),
    ]
)
