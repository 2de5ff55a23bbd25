"""The pinned record layout of a monthly extract and the lookup table names."""

from __future__ import annotations

# Field names and types in file order.
_BASE_FIELDS = {
    "Year": "smallint",
    "Quarter": "tinyint",
    "Month": "tinyint",
    "DayofMonth": "tinyint",
    "DayOfWeek": "tinyint",
    "FlightDate": "string",
    "Reporting_Airline": "string",
    "DOT_ID_Reporting_Airline": "int",
    "IATA_CODE_Reporting_Airline": "string",
    "Tail_Number": "string",
    "Flight_Number_Reporting_Airline": "int",
    "OriginAirportID": "int",
    "OriginAirportSeqID": "int",
    "OriginCityMarketID": "int",
    "Origin": "string",
    "OriginCityName": "string",
    "OriginState": "string",
    "OriginStateFips": "string",
    "OriginStateName": "string",
    "OriginWac": "smallint",
    "DestAirportID": "int",
    "DestAirportSeqID": "int",
    "DestCityMarketID": "int",
    "Dest": "string",
    "DestCityName": "string",
    "DestState": "string",
    "DestStateFips": "string",
    "DestStateName": "string",
    "DestWac": "smallint",
    "CRSDepTime": "int",
    "DepTime": "int",
    "DepDelay": "float",
    "DepDelayMinutes": "float",
    "DepDel15": "tinyint",
    "DepartureDelayGroups": "tinyint",
    "DepTimeBlk": "string",
    "TaxiOut": "float",
    "WheelsOff": "int",
    "WheelsOn": "int",
    "TaxiIn": "float",
    "CRSArrTime": "int",
    "ArrTime": "int",
    "ArrDelay": "float",
    "ArrDelayMinutes": "float",
    "ArrDel15": "tinyint",
    "ArrivalDelayGroups": "tinyint",
    "ArrTimeBlk": "string",
    "Cancelled": "tinyint",
    "CancellationCode": "string",
    "Diverted": "tinyint",
    "CRSElapsedTime": "float",
    "ActualElapsedTime": "float",
    "AirTime": "float",
    "Flights": "tinyint",
    "Distance": "float",
    "DistanceGroup": "tinyint",
    "CarrierDelay": "float",
    "WeatherDelay": "float",
    "NASDelay": "float",
    "SecurityDelay": "float",
    "LateAircraftDelay": "float",
    "FirstDepTime": "int",
    "TotalAddGTime": "float",
    "LongestAddGTime": "float",
    "DivAirportLandings": "tinyint",
    "DivReachedDest": "tinyint",
    "DivActualElapsedTime": "float",
    "DivArrDelay": "float",
    "DivDistance": "float",
}

# The block repeated for each diversion slot.
_SLOT_FIELDS = {
    "Airport": "string",
    "AirportID": "int",
    "AirportSeqID": "int",
    "WheelsOn": "int",
    "TotalGTime": "float",
    "LongestGTime": "float",
    "WheelsOff": "int",
    "TailNum": "string",
}

DIVERSION_SLOTS = range(1, 6)

FIELDS: dict[str, str] = _BASE_FIELDS | {
    f"Div{slot}{name}": dtype
    for slot in DIVERSION_SLOTS
    for name, dtype in _SLOT_FIELDS.items()
}

FIELD_COUNT = 109
if len(FIELDS) != FIELD_COUNT:
    raise ValueError(f"the layout has {len(FIELDS)} fields, {FIELD_COUNT} are expected")

# Every published lookup table.
LOOKUP_TABLES = (
    "L_QUARTERS",
    "L_MONTHS",
    "L_WEEKDAYS",
    "L_UNIQUE_CARRIERS",
    "L_AIRLINE_ID",
    "L_CARRIER_HISTORY",
    "L_AIRPORT",
    "L_AIRPORT_ID",
    "L_AIRPORT_SEQ_ID",
    "L_CITY_MARKET_ID",
    "L_STATE_ABR_AVIATION",
    "L_STATE_FIPS",
    "L_WORLD_AREA_CODES",
    "L_YESNO_RESP",
    "L_ONTIME_DELAY_GROUPS",
    "L_DEPARRBLK",
    "L_CANCELLATION",
    "L_DISTANCE_GROUP_250",
    "L_DIVERSIONS",
)

# The lookups that are modelled, with their two column names.
MODELLED_LOOKUPS = {
    "l_unique_carriers": ("carrier_code", "carrier_name"),
    "l_cancellation": ("cancellation_code", "cancellation_reason"),
    "l_city_market_id": ("city_market_id", "city_market_name"),
    "l_ontime_delay_groups": ("delay_group_code", "delay_group_label"),
}
