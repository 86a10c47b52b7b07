"""Row types of the data sets the jobs read and write, as Spark DDL text."""

FLIGHTS = (
    "Year INT, Month INT, DayofMonth INT, DayOfWeek INT, DepTime INT, CRSDepTime INT, ArrTime INT,"
    "CRSArrTime INT, UniqueCarrier STRING, FlightNum INT, TailNum STRING, ActualElapsedTime INT,"
    "CRSElapsedTime INT, AirTime INT, ArrDelay INT, DepDelay INT, Origin STRING, Dest STRING,"
    "Distance INT, TaxiIn INT, TaxiOut INT, Cancelled INT, CancellationCode STRING, Diverted INT,"
    "CarrierDelay INT, WeatherDelay INT, NASDelay INT, SecurityDelay INT, LateAircraftDelay INT"
)
CARRIERS = "Code STRING, Description STRING"
AIRPORTS = (
    "iata STRING, airport STRING, city STRING, state STRING, country STRING, lat DOUBLE, long DOUBLE"
)
READINGS = (
    "station_id STRING, timestamp TIMESTAMP, temperature DOUBLE, humidity DOUBLE, pressure DOUBLE,"
    "wind_speed DOUBLE, wind_direction DOUBLE, weather_condition STRING"
)
RAW_WEATHER = (
    "station_id STRING, timestamp STRING, temperature DOUBLE, humidity DOUBLE, pressure DOUBLE,"
    "wind_speed DOUBLE, wind_direction DOUBLE, weather_condition STRING, metadata STRING"
)
PROCESSED_WEATHER = (
    "station_id STRING, measurement_time TIMESTAMP, temperature_celsius DOUBLE, humidity_percent DOUBLE,"
    "pressure_hpa DOUBLE, wind_speed_kmh DOUBLE, wind_direction_degrees DOUBLE, weather_condition STRING,"
    "heat_index_celsius DOUBLE, wind_chill_celsius DOUBLE, dew_point_celsius DOUBLE,"
    "processing_timestamp TIMESTAMP, data_quality_score DOUBLE, metadata_json STRING"
)
WEATHER_AGGREGATIONS = (
    "station_id STRING, day INT, hour INT, avg_temperature DOUBLE, min_temperature DOUBLE,"
    "max_temperature DOUBLE, avg_humidity DOUBLE, avg_pressure DOUBLE, avg_wind_speed DOUBLE,"
    "max_wind_speed DOUBLE, measurement_count BIGINT, avg_data_quality DOUBLE, created_at TIMESTAMP"
)
WEATHER_RECORD = (
    "id STRING, station_id STRING, latitude DOUBLE, longitude DOUBLE, temperature DOUBLE, humidity DOUBLE,"
    "pressure DOUBLE, wind_speed DOUBLE, wind_direction DOUBLE, timestamp TIMESTAMP,"
    "metadata MAP<STRING, STRING>, created_at TIMESTAMP"
)
MEASUREMENT = (
    "station_id STRING, timestamp TIMESTAMP, temperature DOUBLE, humidity DOUBLE, pressure DOUBLE,"
    "wind_speed DOUBLE, wind_direction DOUBLE,"
    "location STRUCT<latitude: DOUBLE, longitude: DOUBLE, altitude: DOUBLE, city: STRING, country: STRING>"
)
SENSOR_READINGS = (
    "sensor_id STRING, temperature DOUBLE, humidity DOUBLE, timestamp TIMESTAMP, location STRING,"
    "device_type STRING, battery_level INT, signal_strength INT"
)
HTTP_EVENTS = (
    "event_timestamp TIMESTAMP, method STRING, url STRING, path STRING, client_ip STRING,"
    "user_agent STRING, status_code INT, processing_time_ms DOUBLE, event_type STRING"
)
FISH = (
    "Species STRING, Weight DOUBLE, Length1 DOUBLE, Length2 DOUBLE, Length3 DOUBLE, Height DOUBLE, Width DOUBLE"
)
PREDICTIONS = (
    "species STRING, length1 DECIMAL(8,3), length2 DECIMAL(8,3), length3 DECIMAL(8,3), height DECIMAL(8,3),"
    "width DECIMAL(8,3), predicted_weight DECIMAL(10,3), actual_weight DECIMAL(10,3),"
    "prediction_error DECIMAL(10,3), prediction_date TIMESTAMP, confidence_score DECIMAL(5,3)"
)
LABELLED_TEXT = "text STRING, label INT"
FUNCTION_CALLS = "query STRING, id BIGINT, answers STRING, tools STRING"
USAGE = "date DATE, service STRING, cost DOUBLE, usage DOUBLE"
JOBS = "name STRING, status STRING, creation_time TIMESTAMP"

#: one call; the arguments keep their JSON text so any nesting survives
TOOL_CALL = "array<struct<name: string, arguments: string>>"
