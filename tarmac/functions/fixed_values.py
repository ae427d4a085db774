"""Labels, positions and code tables that results depend on."""

# --- Fixed values: receiver position used to resolve compact positions -------
RECEIVER_LAT = 40.51
RECEIVER_LON = -3.53

# --- Fixed values: emitter category label by type code and category ----------
CATEGORY_LABELS = {
    1: [
        "No category information",
        "Reserved",
        "Reserved",
        "Reserved",
        "Reserved",
        "Reserved",
        "Reserved",
        "Reserved",
    ],
    2: [
        "No category information",
        "Surface emergency vehicle",
        "ERROR",
        "Surface service vehicle",
        "Ground obstruction",
        "Ground obstruction",
        "Ground obstruction",
        "Ground obstruction",
    ],
    3: [
        "No category information",
        "Glider, sailplane",
        "Lighter-than-air",
        "Parachutist, skydiver",
        "Ultralight, hang-glider, paraglider",
        "Reserved",
        "Unmanned aerial vehicle",
        "Space or transatmospheric vehicle",
    ],
    4: [
        "No category information",
        "Light (less than 7000 kg)",
        "Medium 1 (between 7000 kg and 34000 kg)",
        "Medium 2 (between 34000 kg to 136000 kg)",
        "High vortex aircraft",
        "Heavy (larger than 136000 kg)",
        "High performance (>5 g acceleration) and high speed (>400 kt)",
        "Rotorcraft",
    ],
}
NO_CATEGORY = "No category information"
UNINFORMATIVE_LABELS = ["No category information", "Reserved", "ERROR"]
ROTORCRAFT = "Rotorcraft"

# --- Fixed values: airborne position labels ----------------------------------
SURVEILLANCE_STATUS = ["no_condition", "permanent_alert", "temporary_alert", "SPI_condition"]
CPR_FORMAT = ["even_frame", "odd_frame"]
ALTITUDE_BAROMETRIC = "airborne_barometric_alt"
ALTITUDE_GNSS = "airborne_gnss_alt"

# --- Fixed values: runway outlines (lon, lat), in matching order -------------
RUNWAYS = [
    ("18R/36L", [(-3.582, 40.492383), (-3.5695, 40.492383), (-3.5695, 40.537929), (-3.582, 40.537929)]),
    ("18L/36R", [(-3.564441, 40.499172), (-3.549, 40.499172), (-3.549, 40.537472), (-3.564441, 40.537472)]),
    ("14L/32R", [(-3.531683, 40.464310), (-3.524645, 40.468620), (-3.556317, 40.498519), (-3.564652, 40.495647)]),
    ("14R/32L", [(-3.547648, 40.450661), (-3.539580, 40.454710), (-3.575714, 40.488141), (-3.582924, 40.484224)]),
]

# --- Fixed values: map points ------------------------------------------------
RADARS = [("PRINCIPAL", 40.51, -3.53)]
LANDING_STRIPS = [
    ("1", 40.463, -3.554),
    ("2", 40.473, -3.536),
    ("3", 40.507, -3.574),
    ("4", 40.507, -3.559),
]

# --- Fixed values: weekday names, Monday first -------------------------------
WEEKDAYS_EN = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEEKDAYS_ES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
WEEKDAY_LETTERS = ["L", "M", "X", "J", "V", "S", "D"]
GROUND_LABELS = {1: "En Tierra", 0: "En Aire"}

# --- Fixed values: published Mode-S constants --------------------------------
CRC24_POLYNOMIAL = 0x1FFF409
CALLSIGN_ALPHABET = "#ABCDEFGHIJKLMNOPQRSTUVWXYZ##### ###############0123456789######"
FEET_PER_METRE = 3.28084

# --- Fixed values: speed colour limits (kt) and history fading ---------------
SPEED_RED_BELOW = 300
SPEED_YELLOW_BELOW = 450
FLIGHT_FADE = 0.45
DIRECTION_EPSILON = 1e-5
