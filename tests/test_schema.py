from wardbook.schema import CASE_KEPT_COLUMNS, COORDINATE_COLUMNS, RAW_COLUMNS, TIMESTAMP_COLUMNS, UPPER_COLUMNS


def test_every_raw_column_is_in_one_cleaning_group():
    others = ["unique_key", "borough", "location", "raw_json"]
    groups = [TIMESTAMP_COLUMNS, CASE_KEPT_COLUMNS, COORDINATE_COLUMNS, UPPER_COLUMNS, others]
    assert sorted(c for g in groups for c in g) == sorted(RAW_COLUMNS)
    assert len(UPPER_COLUMNS) == 19


def test_upper_columns():
    assert set(UPPER_COLUMNS) == {
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
    }
