"""Names, lists and palettes the published datasets are defined by.

Everything in this module is a fixed value. It has to equal what the users of
the datasets already have, so it is stated as is and used by name elsewhere.
"""

# The 13 indicator columns, in publication order.
INDICATORS = (
    "Theta", "REW", "Psi", "PET", "Precipitation", "AET", "ELW",
    "LAI", "DDS", "LFMC", "DFMC", "SFP", "CFP",
)

# Written next to the indicators, but not cleaned, mapped or averaged.
EXTRA_OUTPUTS = ("Interception", "Esoil", "Eplant", "Runoff", "DeepDrainage")

# The 11 weather variables.
WEATHER_VARS = (
    "MeanTemperature", "MinTemperature", "MaxTemperature",
    "MeanRelativeHumidity", "MinRelativeHumidity", "MaxRelativeHumidity",
    "Precipitation", "Radiation", "WindSpeed", "PET", "ThermalAmplitude",
)

# Weather columns no later step reads.
WEATHER_UNUSED = (
    "geom", "geom_hex", "geom_text", "elevation", "slope", "aspect", "DOY",
    "WindDirection", "TPI", "partition", "day", "month", "year",
)

# Provinces outside the mapped territory, and their file codes.
EXCLUDED_PROVINCES = ("Ceuta", "Melilla", "Palmas, Las", "Santa Cruz de Tenerife")
EXCLUDED_FILE_CODES = "_35_|_38_"

# Folder and mark of the files of initial states.
INITIAL_FOLDER = "data-raw"
INITIAL_MARK = "initialized"

# Administrative levels.
ADMIN_LEVELS = ("provincia", "municipio", "comarca")

# Value of Psi that marks a failed soil solution.
PSI_SENTINEL = -40.0

# Day window and state look-back, in days before the run date.
WINDOW_OLDEST = 385
WINDOW_NEWEST = 5
STATE_OLDEST = 387

# Tags of the run summary.
TAG_FAILED = "lady_beetle"
TAG_FINE = "bell"
NO_ERRORS = "no errors"

# Map layers.
BLOCK_FACTOR = 4
ROUNDING_FACTOR = 1000
HULL_MARGIN = 1000.0
ROWS_PER_FILE = 1_000_000
ROWS_PER_GROUP = 5_000
IMAGES_PER_GROUP = 11
PALETTE_LABEL = "ag_GrnYl"
MISSING_COLOUR = "#FFFFFF00"
REVERSED_RAMPS = ("DDS", "SFP", "CFP")
RAMP_COLOURS = (
    "#FF0D50", "#FB7C82", "#FEABAC", "#FFD7D7", "#F2EFF2",
    "#9AAABA", "#4B8AA1", "#007490", "#006584",
)
PSI_BREAKS = (0.0, 0.45, 0.65, 0.75, 0.8, 0.85, 0.9, 0.95, 1.0)
EVEN_BREAKS = (0.0, 0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1.0)
