"""Schemas and field lists of the nested source documents and the flat bronze record."""

from __future__ import annotations

from pyspark.sql import types as T

# The public document format and bronze layout that results must match.
_RECORD = (
    "id string, name string, relevanceScore string, providerId string, providerHotelId string, "
    "providerName string, language string, geoCode struct<lat: string, long: string>, "
    "contact struct<address: struct<line1: string, city: struct<name: string>, state: struct<name: string>, "
    "country: struct<code: string, name: string>, postalCode: string>, "
    "phones: array<string>, fax: array<string>, emails: array<string>>, "
    "type string, category string, starRating string, distance string, attributes array<string>, "
    "imageCount string, availableSuppliers array<string>"
)
_BRONZE = (
    "id string, name string, relevanceScore string, providerId string, providerHotelId string, "
    "providerName string, language string, geoCode_lat string, geoCode_long string, "
    "contact_address_line1 string, contact_address_city_name string, contact_address_state_name string, "
    "contact_address_country_code string, contact_address_country_name string, contact_address_postalCode string, "
    "contact_phones array<string>, contact_fax array<string>, contact_emails array<string>, "
    "type string, category string, starRating string, distance string, attributes array<string>, "
    "imageCount string, availableSuppliers array<string>, combined_address string, "
    "processing_time_utc timestamp, original_message string"
)
MANDATORY_FIELDS = (
    "geoCode_lat",
    "geoCode_long",
    "name",
    "providerId",
    "contact_address_line1",
    "contact_address_city_name",
    "contact_address_country_name",
)
ADDRESS_FIELDS = (
    "contact_address_line1",
    "contact_address_city_name",
    "contact_address_state_name",
    "contact_address_country_name",
    "contact_address_postalCode",
)
RAW_COLUMN = "original_message"
TIME_COLUMN = "processing_time_utc"
ADDRESS_COLUMN = "combined_address"


def record_schema() -> T.StructType:
    return T._parse_datatype_string(_RECORD)


def document_schema() -> T.StructType:
    """One source document: many records, plus a curated list that carries no fields."""
    return T.StructType(
        [
            T.StructField("hotels", T.ArrayType(record_schema())),
            T.StructField("curatedHotels", T.ArrayType(T.StructType([]))),
        ]
    )


def bronze_schema() -> T.StructType:
    return T._parse_datatype_string(_BRONZE)
