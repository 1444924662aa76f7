"""Declared schemas. Columns of headerless CSV files bind to them by position."""

# Names, order and types of the public city and taxi trip files.

CITY_SCHEMA = "CityName STRING, Population INT, Area DOUBLE, CulturalSites INT, CityID INT"

TRIP_SCHEMA = (
    "VendorID INT, tpep_pickup_datetime TIMESTAMP, tpep_dropoff_datetime TIMESTAMP, "
    "passenger_count INT, trip_distance DOUBLE, pickup_longitude DOUBLE, "
    "pickup_latitude DOUBLE, RateCodeID INT, store_and_fwd_flag STRING, "
    "dropoff_longitude DOUBLE, dropoff_latitude DOUBLE, payment_type INT, "
    "fare_amount DOUBLE, extra DOUBLE, mta_tax DOUBLE, tip_amount DOUBLE, "
    "tolls_amount DOUBLE, improvement_surcharge DOUBLE, total_amount DOUBLE"
)
