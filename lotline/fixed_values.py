"""Fixed values.

Word lists, patterns and constants that decide results and so must be exactly these.
Everything here is data; the logic that uses it is in the other modules.
"""

# --- fixed values: sizes in free text -------------------------------------------------
EXCLUSION_WORDS = [
    "terraza", "balc[oó]n", "balcn", "patio", "chimenea", "deposito", "jardin", "garaje",
    "parqueadero", "altillo", "piscina", "gimnasio", "alcoba", "habitacion", "bano", "garajes",
    "parque", "balcones", "bbq", "altura", "terrazas",
]
CONTEXT_UNITS = (
    r"m\^?\d{1,2}|m²|m2|mts2|mts|mt2|mtr?s?|mtrs2|mtrs|metrs2?|metros cuadrados?|mas|ms|m\d{1,2}|m"
)
SURFACE_UNITS = (
    r"m\^?\d{1,2}\b|m²\b|m2\b|mts2\b|mts\b|mt2\b|mtr?s?\b|mtrs2\b|mtrs\b|metrs2?\b"
    r"|metros cuadrados?\b|mt\b|\bm\b"
)
CONTEXT_WORDS = 5
LENGTH_UNITS = r"m(²|2)?|mts?|mt2?|mtr?s?|metrs?|metros?|mts2|m2|\*"
LENGTH_SEPARATORS = r"x|por|\*"
WATCH_HOURS = r"^\s*24\s*[xX]\s*7\s*$|^\s*7\s*[xX]\s*24\s*$"
AREA_LABEL = r"(area|área|superficie)\s+(total\s+)?(construida|construido)"
AREA_LABEL_UNITS = r"m²|m2|mts2|mts|mt2|metros cuadrados?"
MIN_MINED_SURFACE = 25

# --- fixed values: type of housing ----------------------------------------------------
HOUSE = "Casa"
FLAT = "Apartamento"
HOUSE_WORDS = ["casa"]
FLAT_WORDS = [
    "apartamento", "apto", "apt", "paratmento", "aparta estudio", "apartamentos",
    "apartaestudio", "aparatmento", "penthouse", "peth house", "edificio", "paratmento",
    "pent house", "apartanento", "aptos", "aptaestudio", "apartamneto", "penhouse",
    "apatamento", "apta", "aptestudio",
]

# --- fixed values: counts in words ----------------------------------------------------
NUMBER_WORDS = {
    "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5,
    "seis": 6, "siete": 7, "ocho": 8, "nueve": 9, "diez": 10,
}
BATH_NOUN = r"baños?|banos?"
BATH_LIMIT = 22

# --- fixed values: amenity flags, one edit allowed ------------------------------------
AMENITY_WORDS = {
    "piscina": ["piscina"],
    "garaje": ["garaje", "parqueadero"],
    "seguridad": ["vigilancia", "seguridad"],
    "balcon": ["balcon", "terraza"],
    "gym": ["gimnasio", "gym"],
}

# --- fixed values: keys and column lists ----------------------------------------------
EXACT_COPY_KEYS = [
    "year", "month", "surface_total", "surface_covered", "rooms", "bedrooms", "bathrooms",
    "price", "lat", "lon",
]
REPUBLISHED_KEYS = [
    "surface_total", "surface_covered", "rooms", "bedrooms", "bathrooms", "lat", "lon",
]
CLEAN_COLUMNS = [
    "property_id", "city", "price", "month", "year", "surface_total", "bedrooms", "bathrooms",
    "type_housing", "description_adj", "lat", "lon",
    "piscina", "garaje", "seguridad", "balcon", "gym",
]
PREDICTORS = [
    "surface_total", "bedrooms", "bathrooms", "apto_casa", "piscina", "garaje", "seguridad",
    "balcon", "gym", "year", "dist_parque", "AVALUO_COM", "dist_centComercial", "dist_cai",
    "dist_transmi", "num_paraderos_sitp", "num_colegios", "ESTRATO", "num_restaurantes",
]
EXCLUDED_PARK_TYPES = [
    "PARQUE DE BOLSILLO", "PARQUE ZONAL PROPUESTO", "PARQUE METROPOLITANO PROPUESTO",
]

# --- fixed values: radii in metres, constants -----------------------------------------
RADIUS_BUS_STOPS = 300.0
RADIUS_SCHOOLS = 500.0
RADIUS_RESTAURANTS = 500.0
RADIUS_STRATUM = 400.0
BLOCK_SIZE = 1200.0
TRIM_SDS = 2
IMPUTED_BATHROOMS = 2.0
IMPUTED_SURFACE = 121.0

# --- fixed values: projections (semi-major axis, inverse flattening, origin) ----------
GRS80 = (6378137.0, 298.257222101)
WGS84 = (6378137.0, 298.257223563)
CITY_PLANE_ELLIPSOID = (6380687.0, 298.257222101)
MAGNA_BOGOTA = {
    "lon0": -74.0775079166667, "lat0": 4.59620041666667,
    "false_easting": 1000000.0, "false_northing": 1000000.0, "scale": 1.0,
}
CITY_PLANE = {
    "lon0": -74.14659167, "lat0": 4.680486111,
    "false_easting": 92334.879, "false_northing": 109320.965, "scale": 1.0,
}

# --- fixed values: tuning grids -------------------------------------------------------
FOREST_GRID = {"mtry": [2, 4, 6, 8], "min_node": [1, 5, 10]}
FOREST_TREES = 1000
BOOSTING_GRID = {
    "depth": [5, 7, 9], "trees": [500, 750, 1000], "shrinkage": [0.01, 0.005],
    "min_node": [10, 15],
}
BOOSTING_BAG = 0.8
ELASTIC_NET_NUMERIC = [
    "surface_total", "bedrooms", "bathrooms", "piscina", "garaje", "seguridad", "balcon", "gym",
    "dist_parque", "AVALUO_COM", "dist_centComercial", "dist_cai", "dist_transmi",
    "num_paraderos_sitp", "num_colegios", "ESTRATO", "num_restaurantes",
]
ELASTIC_NET_RECIPES = {
    1: {"interactions": [("dist_transmi", "ESTRATO"), ("AVALUO_COM", "ESTRATO")], "polynomials": []},
    2: {"interactions": [("dist_parque", "ESTRATO"), ("AVALUO_COM", "ESTRATO"), ("dist_transmi", "ESTRATO")],
        "polynomials": ["surface_total", "AVALUO_COM", "dist_parque", "dist_centComercial"]},
}
TREE_CP_GRID = [i / 1000 for i in range(31)]
NETWORK_UNITS = (10, 10)
NETWORK_DROPOUT = 0.2
EARLY_STOP_PATIENCE = 20
