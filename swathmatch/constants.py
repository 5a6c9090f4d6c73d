"""Codes, thresholds and tables the results depend on.

Nothing here is computed; changing one of these changes results.
"""

# --- fixed values: geometry -------------------------------------------------
EARTH_RADIUS_KM = 6371.0
KM_PER_DEG_GRID = 111.32        # scene pixel spacing, difference grid
KM_PER_DEG_RADAR = 111.0        # radar grids, coordinate snapping, footprint padding
KM_PER_DEG_RADIUS_BUFFER = 100.0    # pre-filter of the radius join
KM_PER_DEG_NEAREST_BUFFER = 55.0    # pre-filter of the nearest join and domain crop
GRANULE_PAD_DEG = 5.0
CROSS_TRACK_STEP_KM = 50.0
DEFAULT_FOOTPRINT_RADIUS_KM = 14.0

# --- fixed values: quality codes --------------------------------------------
VALID_QC_CODES = (1, 2, 5, 7, 8)
WIND_CELL_REJECT_FLAGS = (
    "some_portion_of_wvc_is_over_land",
    "some_portion_of_wvc_is_over_ice",
    "wind_inversion_not_successful",
    "not_enough_good_sigma0_for_wind_retrieval",
    "distance_to_gmf_too_large",
)
QUALITY_REJECT_LABELS = ("no_data", "bad", "poor", "low", "suspect")
WAVE_LAND_FLAG = 1
WAVE_QUALITY_REJECT_FROM = 2
BYTEMAP_RESERVED_FROM = 251

# --- fixed values: statistics -----------------------------------------------
MIN_N_FOR_CORRELATION = 10
MEAN_EPSILON = 1e-10
CDF_MIN_BINS = 2
CDF_MAX_BINS = 10
CDF_ROWS_PER_BIN = 20
HISTOGRAM_BINS = 30
IMBALANCE_SHARE = 0.7
DENSE_MATCHES_PER_SCENE = 300

# --- fixed values: variables ------------------------------------------------
AUXILIARY_VARS = (
    "oswLandFlag", "oswQualityFlag",
    "owiNrcs", "owiIncidenceAngle", "owiHeading", "owiMask",
    "owiWindQuality", "owiInversionQuality",
    "rvlHeading", "rvlIncidenceAngle",
)
CIRCULAR_VAL_VARS = ("WDIR",)
WAVE_HEIGHT_VARS = ("VHM0", "VAVH", "VGHS")
MERGED_WAVE_VAR = "SWH"
VARIABLE_PAIRS = {
    "wind": (("owiWindSpeed", "WSPD"), ("owiWindDirection", "WDIR")),
    "currents": (("rvlRadVel", "rvlRadVel_projection"),),
    "waves": (("oswTotalHs", "VHM0"), ("oswHs", "VHM0"), ("owiHs", "VHM0")),
    "soil_moisture": (("sarSSM", "SOIL_MOISTURE"),),
}
INSITU_VARIABLES = {
    "waves": ("VHM0", "VAVH", "VGHS"),
    "wind": ("WSPD", "WDIR"),
    "currents": ("EWCT", "NSCT", "HCDT", "HCSP"),
}

# --- fixed values: platforms and sources ------------------------------------
PLATFORM_LABELS = {
    "MO": "mooring", "DB": "buoy", "FB": "ferrybox", "TG": "tidal_gauge", "AD": "drifter",
}
SOURCE_PLATFORM_CODES = {
    "mooring": ("MO",),
    "buoy_cmems": ("DB",),
    "buoy_cmems_family": ("MO", "DB", "AD"),
    "buoy_waterfall": ("DB",),
    "ship_cmems_family": ("FB",),
    "drifter": ("DB", "AD"),
    "tidal_gauge": ("TG",),
}
GROUP_ALIASES = {"mooring": "buoy_family", "buoy": "buoy_family"}
UNITS_FAMILY = {
    "ismn": "volumetric",
    "ascat_ssm": "percent_saturation",
    "amsr_ssm": "volumetric",
    "smap_ssm": "volumetric",
    "smos_ssm": "volumetric",
    "era5_soil_moisture": "volumetric",
}
UNIT_FAMILIES = {
    "": "unknown",
    "%": "percent_saturation",
    "percent": "percent_saturation",
    "m3 m-3": "volumetric",
    "m3/m3": "volumetric",
    "cm3 cm-3": "volumetric",
    "cm3/cm3": "volumetric",
    "1": "volumetric",
}
LAYER_DATA_TYPES = (
    "scatterometer", "altimeter", "hf_radar", "hf_radar_grid", "radiometer",
    "scatterometer_ssm", "radiometer_ssm", "cds_ssm",
    "era5_wind", "era5_waves", "era5_soil_moisture", "hycom",
)
LAYER_SOURCE_PATHS = (
    "osi_saf_winds", "scatterometer", "altimeter", "hf_radar", "hf_radar_grid", "hfr_noaa",
    "radiometer", "ascat_ssm", "amsr_ssm", "smap_ssm", "smos_ssm", "cds_ssm",
)
SOIL_SATELLITE_LAYERS = (
    "scatterometer_ssm", "radiometer_ssm", "amsr_ssm", "smap_ssm", "smos_ssm", "cds_ssm",
)
SOIL_CATEGORY = {
    "ascat_ssm": "Scatterometer",
    "amsr_ssm": "Radiometer",
    "smap_ssm": "Radiometer",
    "smos_ssm": "Radiometer",
    "scatterometer_ssm": "Scatterometer",
    "radiometer_ssm": "Radiometer",
}
# the data type a step of a node's path stands for, in the order they are tried
PATH_DATA_TYPES = {
    "scatterometer": "scatterometer",
    "osi_saf_winds": "scatterometer",
    "winds": "scatterometer",
    "altimeter": "altimeter",
    "radiometer": "radiometer",
    "hf_radar": "hf_radar",
    "hfr_noaa": "hf_radar_grid",
    "hf_radar_grid": "hf_radar_grid",
    "amsr_ssm": "amsr_ssm",
    "smap_ssm": "smap_ssm",
    "smos_ssm": "smos_ssm",
}
DEFAULT_FREQUENCY = "1hz"
# data type, step of the path (if any), key of the layer table
LAYER_RULES = (
    ("scatterometer", "scatterometer_hy2b", "scatterometer_hy2b"),
    ("scatterometer", "scatterometer_hy2c", "scatterometer_hy2c"),
    ("scatterometer", "scatterometer_oceansat3", "scatterometer_oceansat3"),
    ("altimeter", None, "altimeter_{frequency}"),
    ("radiometer", None, "radiometer_{sensor}"),
    ("radiometer_ssm", None, "{sensor}_ssm"),
)
# relays and the sources whose stations they pass on; a waterfall with its relay
RELAYS = {
    "buoy_gts": ("mooring", "buoy_cmems"),
    "ship_gts": ("ship_cmems_family",),
}
WATERFALL_PAIR = {"buoy_gts", "buoy_waterfall"}
HISTORICAL_FIRST_PAIRS = {"hf_radar": "hf_radar_historical", "drifter": "drifter_historical"}
TOLERANCE_ALIASES = {"ascat_ssm": "scatterometer_ssm"}

# --- fixed values: depth windows (metres) -----------------------------------
DEFAULT_MIN_DEPTH = -20.0
DEFAULT_MAX_DEPTH = 20.0
SOIL_MIN_DEPTH = 0.0
SOIL_MAX_DEPTH = 0.05

# --- fixed values: layer specs ----------------------------------------------
# layer type: (time tolerance in minutes, aggregation radius in km)
_LAYER_TOLERANCE_AND_RADIUS = {
    "scatterometer": (180, 12.5),
    "scatterometer_hy2b": (180, 25.0),
    "scatterometer_hy2c": (180, 25.0),
    "scatterometer_oceansat3": (180, 25.0),
    "altimeter_1hz": (180, 7.0),
    "altimeter_5hz": (180, 1.4),
    "altimeter_reprocessed": (180, 7.0),
    "hf_radar_grid": (30, 6.0),
    "radiometer": (180, 25.0),
    "radiometer_amsr2": (180, 25.0),
    "radiometer_gmi": (180, 25.0),
    "radiometer_ssmis_f16": (180, 25.0),
    "radiometer_ssmis_f17": (180, 25.0),
    "radiometer_ssmis_f18": (180, 25.0),
    "radiometer_windsat": (180, 25.0),
    "radiometer_amsre": (180, 25.0),
    "scatterometer_ssm": (720, 12.5),
    "radiometer_ssm": (720, 25.0),
    "amsr_ssm": (720, 25.0),
    "smap_ssm": (720, 9.0),
    "smos_ssm": (720, 35.0),
    "cds_ssm": (720, 25.0),
    "era5_wind": (120, 12.5),
    "era5_waves": (120, 12.5),
    "era5_soil_moisture": (720, 5.0),
    "hycom": (360, 4.6),
}
MODEL_LAYERS = ("era5_wind", "era5_waves", "era5_soil_moisture", "hycom")
MODEL_CADENCE_HOURS = {"hycom": 3, "era5_wind": 1, "era5_waves": 1, "era5_soil_moisture": 1}
LAYER_SPECS = {
    name: {
        "time_tolerance_minutes": tol,
        "aggregation_window_km": km,
        "distance_weighting": "equal",
        **({"dedup_nearest_in_time": True} if name == "hf_radar_grid" else {}),
        **({"method": "cell-averaging", "temporal_method": "hyperbolic"} if name in MODEL_LAYERS else {}),
    }
    for name, (tol, km) in _LAYER_TOLERANCE_AND_RADIUS.items()
}

# --- fixed values: file name patterns ---------------------------------------
RADAR_NAME_OLD = r"^(\d{12})_hfr_[a-z]+_(\d+km|500m)_rtv_uwls_NDBC\.nc$"
RADAR_NAME_NEW = r"^rtv-[a-z]+-(\d+km|500m)-uwls_v1r0_hfr_s(\d{15})_e\d{15}_c\d{15}\.nc$"
WIND_NAME_OLD = (
    r"^RSAT2_[A-Za-z0-9]+_(\d{4})_(\d{2})_(\d{2})_(\d{2})_(\d{2})_(\d{2})_\d+_"
    r"(\d+(?:\.\d+)?)([EW])_(\d+(?:\.\d+)?)([NS])_.*_wind_level2_norcs\.nc$"
)
WIND_NAME_NEW = (
    r"^SAR-Wind-[A-Z]+-(\d+)([NS])-(\d+)([EW])_v\d+r\d+_rsat2_s(\d{15})_e\d{15}_c\d{15}\.nc$"
)
RESOLUTION_IN_NAME = r"-(\d+\.?\d*)km-"
DEFAULT_NAME_RESOLUTION_KM = 12.5
SCENE_STAMP_IN_NAME = r"(?i)(\d{8}t\d{6})"
DATE_TOKEN_IN_NAME = r"(\d{12}|\d{8})"

# --- fixed values: coverage dates -------------------------------------------
CURRENT_MODEL_FIRST_DAY = "2018-12-04T00:00:00"
CURRENT_MODEL_CUTOVER = "2024-08-10T00:00:00"
CURRENT_MODEL_SEGMENTS = ("gofs31_930", "espc_d_v02")

# --- fixed values: scene products and the variables each one carries ---------
SCENE_SOURCES = {
    "sentinel1_l2_ocn": ("wind", "waves", "currents"),
    "sentinel1_clms_ssm": ("soil_moisture",),
    "nisar_sme2": ("soil_moisture",),
    "radarsat2": ("wind",),
}
