"""Payload schemas (Spark DDL) of the six API sources.

Every leaf is read as STRING and cast later with the tolerant helpers, so a quoted number
and a bare number give the same value.
"""

WORLDBANK_OBS = (
    "array<struct<indicator:struct<id:string,value:string>,country:struct<id:string,value:string>,"
    "countryiso3code:string,date:string,value:string,unit:string,obs_status:string,decimal:string>>"
)

WIKIMEDIA = (
    "struct<items:array<struct<project:string,article:string,granularity:string,access:string,"
    "agent:string,timestamp:string,views:string>>>"
)

OPENMETEO = (
    "struct<latitude:string,longitude:string,"
    "hourly:struct<time:array<string>,temperature_2m:array<string>,relativehumidity_2m:array<string>>>"
)

GITHUB = (
    "array<struct<sha:string,commit:struct<author:struct<name:string,date:string>,"
    "committer:struct<name:string>,message:string,verification:struct<verified:string>>,"
    "verification:struct<verified:string>>>"
)

OPENAQ = (
    "struct<results:array<struct<locationId:string,sensorId:string,parameter:string,unit:string,"
    "date:struct<utc:string>,value:string,coordinates:struct<latitude:string,longitude:string>>>>"
)

USGS = (
    "struct<features:array<struct<id:string,properties:struct<title:string,mag:string,time:string,"
    "place:string>,geometry:struct<coordinates:array<string>>>>>"
)
