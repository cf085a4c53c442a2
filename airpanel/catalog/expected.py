"""Constants of the SQL side, written out on their own: a wrong constant in the library must not also be in its check."""

# Concentrations of the six bands of each pollutant, and the index of each band.
BAND_INDEX = [(0, 50), (51, 100), (101, 200), (201, 300), (301, 400), (401, 500)]
BANDS = {
    "pm25": [(0, 30), (31, 60), (61, 90), (91, 120), (121, 250), (251, 500)],
    "pm10": [(0, 50), (51, 100), (101, 250), (251, 350), (351, 430), (431, 600)],
    "no2": [(0, 40), (41, 80), (81, 180), (181, 280), (281, 400), (401, 500)],
    "so2": [(0, 40), (41, 80), (81, 380), (381, 800), (801, 1600), (1601, 2000)],
    "co": [(0, 1.0), (1.1, 2.0), (2.1, 10.0), (10.1, 17.0), (17.1, 34.0), (34.1, 50.0)],
    "o3": [(0, 50), (51, 100), (101, 168), (169, 208), (209, 748), (749, 1000)],
}
POLLUTANTS = ["pm25", "pm10", "no2", "so2", "co", "o3"]

# Colours on the map and in the service, and the advice per category.
MAP_COLORS = {
    "Good": "#00E400", "Satisfactory": "#92D050", "Moderate": "#FFFF00",
    "Poor": "#FF7E00", "Very Poor": "#FF0000", "Severe": "#7E0023",
}
SERVICE_COLORS = {
    "Good": "#00E400", "Satisfactory": "#92D050", "Moderate": "#FFFF00",
    "Poor": "#FF7E00", "Very Poor": "#FF0000", "Severe": "#8F3F97",
}
ADVISORIES = {
    "Good": "Air quality is satisfactory. Enjoy outdoor activities!",
    "Satisfactory": "Air quality is acceptable. Sensitive individuals should limit prolonged outdoor exertion.",
    "Moderate": "May cause breathing discomfort to sensitive people. Reduce prolonged outdoor activities.",
    "Poor": "May cause breathing discomfort to people on prolonged exposure. Avoid outdoor activities.",
    "Very Poor": "May cause respiratory illness on prolonged exposure. Avoid outdoor activities, stay indoors.",
    "Severe": "Health alert! May affect healthy people. Avoid all outdoor activities, use air purifiers.",
}
DEFAULT_ADVISORY = "Check air quality before outdoor activities."

# Festival days, and the lags and frames of the feature jobs in hours.
FESTIVAL_DATES = ["2022-10-24", "2023-11-12", "2024-11-01"]
LAGS = [1, 6, 24]
LONG_LAGS = [1, 3, 6, 12, 24]
WINDOWS = [24, 72]
