"""Constants, thresholds, messages and templates that results depend on.

Everything in this file is given by the specification of the jobs and must be
equal to it for results to be right. Nothing here is computed.
"""

# --- fixed values: heat index, as (coefficient, power of temperature, power of humidity)
HEAT_INDEX_MIN_TEMPERATURE = 27.0
HEAT_INDEX_TERMS = [
    (-42.379, 0, 0),
    (2.04901523, 1, 0),
    (10.14333127, 0, 1),
    (-0.22475541, 1, 1),
    (-6.83783e-3, 2, 0),
    (-5.481717e-2, 0, 2),
    (1.22874e-3, 2, 1),
    (8.5282e-4, 1, 2),
    (-1.99e-6, 2, 2),
]
#: how many of the terms above each job uses
HEAT_INDEX_VARIANTS = {"stream": 3, "batch": 4, "full": 9}

# --- fixed values: wind chill
WIND_CHILL_MAX_TEMPERATURE = 10.0
WIND_CHILL_MIN_WIND = 4.8
WIND_CHILL_EXPONENT = 0.16
WIND_CHILL_BASE = 13.12
WIND_CHILL_PER_DEGREE = 0.6215
WIND_CHILL_PER_WIND = -11.37
WIND_CHILL_PER_DEGREE_WIND = 0.3965

# --- fixed values: Magnus dew point
MAGNUS_A = 17.27
MAGNUS_B = 237.7

# --- fixed values: physical bounds of a weather reading (inclusive)
READING_BOUNDS = {
    "temperature": (-50.0, 60.0),
    "humidity": (0.0, 100.0),
    "pressure": (800.0, 1200.0),
    "wind_speed": (None, 200.0),
    "wind_direction": (0.0, 360.0),
}
STREAM_READING_BOUNDS = {
    "temperature": (-50.0, 60.0),
    "humidity": (0.0, 100.0),
    "pressure": (800.0, 1200.0),
}
READING_KEYS = ("station_id", "timestamp")
SUSPICIOUS_BELOW = 0.1
SUSPICIOUS_MESSAGE = "Suspiciously low readings - possible sensor malfunction"

# --- fixed values: alert level ladder (first match wins)
ALERT_HOT_ABOVE = 35.0
ALERT_COLD_BELOW = -10.0
ALERT_WIND_ABOVE = 100.0
ALERT_LEVELS = ("HIGH_HEAT", "EXTREME_COLD", "HIGH_WIND", "NORMAL")

# --- fixed values: alerts raised per reading
EXTREME_HOT_ABOVE = 40.0
EXTREME_COLD_BELOW = -20.0
EXTREME_HIGH_SEVERITY_ABS = 45.0
STRONG_WIND_ABOVE = 80.0

# --- fixed values: declarative constraints of a nested measurement
MEASUREMENT_MESSAGES = {
    "station_id": "Station ID cannot be null",
    "timestamp": "Timestamp cannot be null",
    "temperature_min": "Temperature must be greater than -100°C",
    "temperature_max": "Temperature must be less than 100°C",
    "humidity_min": "Humidity must be non-negative",
    "humidity_max": "Humidity cannot exceed 100%",
    "pressure_min": "Pressure must be greater than 800 hPa",
    "pressure_max": "Pressure must be less than 1200 hPa",
    "wind_speed_min": "Wind speed must be non-negative",
    "wind_direction_min": "Wind direction must be non-negative",
    "wind_direction_max": "Wind direction cannot exceed 360 degrees",
    "latitude": "Latitude cannot be null",
    "latitude_range": "Latitude must be between -90 and 90 degrees",
    "longitude": "Longitude cannot be null",
    "longitude_range": "Longitude must be between -180 and 180 degrees",
}

# --- fixed values: sensor records
SENSOR_ID_MESSAGE = "Sensor ID cannot be null or empty"
SENSOR_NULL_MESSAGE = "Temperature value cannot be null"
SENSOR_RANGE_MESSAGE = "Temperature value out of reasonable range: "
SENSOR_TEMPERATURE_LIMIT = 100.0

# --- fixed values: fish measurements
FISH_SPECIES = ["Bream", "Roach", "Whitefish", "Parkki", "Perch", "Pike", "Smelt"]
FISH_MEASURES = ["length1", "length2", "length3", "height", "width"]
FISH_MAX_MEASURE = 100.0
FISH_SPECIES_MESSAGE = "Species must be one of: "
FISH_POSITIVE_MESSAGE = "Measurements must be positive"
FISH_UNREALISTIC_MESSAGE = "Measurement seems unrealistic (>100cm)"

# --- fixed values: flight delay labels
DELAYED_ABOVE = 15
EARLY_BELOW = -10

# --- fixed values: great-circle distance
EARTH_RADIUS_KM = 6371.0

# --- fixed values: quality bands for R², and budget status
R2_BANDS = [(0.9, "outstanding"), (0.85, "excellent"), (0.7, "good"), (0.5, "moderate")]
R2_BAND_ELSE = "poor"
BUDGET_WARNING_PCT = 80.0
BUDGET_EXCEEDED_PCT = 100.0

# --- fixed values: forecast confidence and band per day ahead
FORECAST_MIN_CONFIDENCE = 0.6
FORECAST_DECAY_PER_DAY = 0.1
FORECAST_BAND_BASE = 1.0
FORECAST_BAND_PER_DAY = 0.5

# --- fixed values: sensor feature set
LAG_STEPS = [1, 2, 3, 6, 12, 24]
ROLLING_WIDTHS = [3, 6, 12, 24]
DIFF_STEPS = [1, 24]
DEFAULT_HUMIDITY = 50.0
RATIO_EPSILON = 1e-6

# --- fixed values: request and error monitors
REQUEST_WINDOW_MS = 300_000
REQUEST_THRESHOLD = 100
REQUEST_SUPPRESS_MS = 3_600_000
REQUEST_STATE_TTL_MS = 24 * 3_600_000
ERROR_WINDOW_MS = 600_000
ERROR_MIN_REQUESTS = 10
ERROR_PCT_ABOVE = 10.0
ERROR_STATE_TTL_MS = 3_600_000
ERROR_STATUS_FROM = 400

# --- fixed values: text classification sets
SENTIMENT_PROMPT = "Classify the sentiment of the following text: "
SENTIMENT_NAMES = {0: "negative", 1: "positive"}
MIN_TEXT_CHARS = 1
MAX_TEXT_CHARS = 512

# --- fixed values: function-calling prompt, cut at the places where the tool list and query go
TOOL_PROMPT_HEAD = "You are an AI assistant with access to the following tools:\n\n"
TOOL_PROMPT_MIDDLE = (
    "\n\nBased on the user's query, determine which tool(s) to call and with what arguments.\n"
    "Your response should be a JSON array of tool calls in the format:\n"
    '[{"name": "tool_name", "arguments": {"param": "value"}}]\n\n'
    "User Query: "
)
TOOL_PROMPT_TAIL = "\n\nTool Calls:"

# --- fixed values: cost recommendations
COST_DAILY_ABOVE = 10.0
COST_FAILURE_RATE_ABOVE = 0.2
COST_RUNNING_ABOVE = 3
COST_GENERAL_ADVICE = [
    "Monitor costs daily during active training periods",
    "Use smaller datasets for initial experiments",
    "Set up billing alerts for early warning",
    "Clean up unused model artifacts in S3",
]

#: Fixed names of the layers: raw column, its type, processed column, its type
READING_MAPPING = [
    ("station_id", "string", "station_id", "string"),
    ("timestamp", "timestamp", "measurement_time", "timestamp"),
    ("temperature", "double", "temperature_celsius", "double"),
    ("humidity", "double", "humidity_percent", "double"),
    ("pressure", "double", "pressure_hpa", "double"),
    ("wind_speed", "double", "wind_speed_kmh", "double"),
    ("wind_direction", "double", "wind_direction_degrees", "double"),
    ("weather_condition", "string", "weather_condition", "string"),
    ("metadata", "string", "metadata_json", "string"),
]
