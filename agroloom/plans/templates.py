"""Fixed export schemas, defaults and print formats."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "date": T.DateType()}
_TYPES |= {f"array<{k}>": T.ArrayType(v) for k, v in _TYPES.items()}


def _schema(text: str) -> T.StructType:
    """Schema of a ``name type, name type`` list; needs no running session."""
    pairs = [part.split(" ") for part in text.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns, order and types of every section. Composite sections keep their layers
# in arrays (event and layer columns of one length).
SECTION_DDL = {
    "GENERAL": "PEOPLE string, ADDRESS string, SITE string, PAREA double, PRNO double, PLEN double, PLDR double, "
    "PLSP double, PLAY string, HAREA double, HRNO double, HLEN double, HARM string, NOTES array<string>",
    "TREATMENTS": "N double, R double, O double, C double, TNAME string, CU double, FL double, SA double, IC double, "
    "MP double, MI double, MF double, MR double, MC double, MT double, ME double, MH double, SM double",
    "CULTIVARS": "C double, CR string, INGENO string, CNAME string",
    "FIELDS": "L double, ID_FIELD string, WSTA string, FLSA string, FLOB double, FLDT string, FLDD double, "
    "FLDS double, FLST string, SLTX string, SLDP double, ID_SOIL string, FLNAME string, XCRD double, YCRD double, "
    "ELEV double, AREA double, SLEN double, FLWR double, SLAS double, FLHST string, FHDUR double",
    "SOIL_ANALYSIS": "A double, SADAT date, SMHB string, SMPX string, SMKE string, SANAME string, SABL array<double>, "
    "SADM array<double>, SAOC array<double>, SANI array<double>, SAPHW array<double>, SAPHB array<double>, "
    "SAPX array<double>, SAKE array<double>, SASC array<double>",
    "INITIAL_CONDITIONS": "C double, PCR string, ICDAT date, ICRT double, ICND double, ICRN double, ICRE double, "
    "ICWD double, ICRES double, ICREN double, ICREP double, ICRIP double, ICRID double, ICNAME string, "
    "ICBL array<double>, SH2O array<double>, SNH4 array<double>, SNO3 array<double>",
    "PLANTING_DETAILS": "P double, PDATE date, EDATE date, PPOP double, PPOE double, PLME string, PLDS string, "
    "PLRS double, PLRD double, PLDP double, PLWT double, PAGE double, PENV double, PLPH double, SPRL double, "
    "PLNAME string",
    "TILLAGE": "T double, TDATE date, TIMPL string, TDEP double, TNAME string",
    "IRRIGATION": "I double, EFIR double, IDEP double, ITHR double, IEPT double, IOFF string, IAME string, "
    "IAMT double, IRNAME string, IDATE array<date>, IROP array<string>, IRVAL array<double>",
    "FERTILIZERS": "F double, FDATE date, FMCD string, FACD string, FDEP double, FAMN double, FAMP double, "
    "FAMK double, FAMC double, FAMO double, FOCD string, FERNAME string",
    "RESIDUES": "R double, RDATE date, RCOD string, RAMT double, RESN double, RESP double, RESK double, RINP double, "
    "RDEP double, RMET string, RENAME string",
    "CHEMICALS": "C double, CDATE date, CHCOD string, CHAMT double, CHME string, CHDEP double, CHT string, CHNAME string",
    "ENVIRONMENT_MODIFICATIONS": "E double, ODATE date, EDAY double, ERAD double, EMAX double, EMIN double, "
    "ERAIN double, ECO2 double, EDEW double, EWIND double, ENVNAME string",
    "HARVEST": "H double, HDATE date, HSTG string, HCOM string, HSIZE string, HPC double, HBPC double, HNAME string",
    "SIMULATION_CONTROLS": "N double, GENERAL string, NYERS double, NREPS double, START string, SDATE string, "
    "RSEED double, SNAME string, SMODEL string, OPTIONS string, WATER string, NITRO string, SYMBI string, "
    "PHOSP string, POTAS string, DISES string, CHEM string, TILL string, CO2 string, METHODS string, WTHER string, "
    "INCON string, LIGHT string, EVAPO string, INFIL string, PHOTO string, HYDRO string, NSWIT double, MESOM string, "
    "MESEV string, MESOL double, MANAGEMENT string, PLANT string, IRRIG string, FERTI string, RESID string, "
    "HARVS string, OUTPUTS string, FNAME string, OVVEW string, SUMRY string, FROPT double, GROUT string, "
    "CAOUT string, WAOUT string, NIOUT string, MIOUT string, DIOUT string, VBOSE string, CHOUT string, OPOUT string, "
    "FMOPT string, PLANTING string, PFRST string, PLAST string, PH2OL double, PH2OU double, PH2OD double, "
    "PSTMX double, PSTMN double, IRRIGATION string, IMDEP double, ITHRL double, ITHRU double, IROFF string, "
    "IMETH string, IRAMT double, IREFF double, NITROGEN string, NMDEP double, NMTHR double, NAMNT double, "
    "NCODE string, NAOFF string, RESIDUES string, RIPCN double, RTIME double, RIDEP double, HARVEST string, "
    "HFRST string, HLAST string, HPCNP double, HPCNR double, SIMDATES string, ENDAT string, SDUR double, "
    "FODAT string, FSTRYR double, FENDYR double, FWFILE string, FONAME string",
}

# What SIMULATION_CONTROLS holds when the data bring none.
CONTROL_DEFAULTS = {
    "N": 1.0, "GENERAL": "GE", "NYERS": 1.0, "NREPS": 1.0, "START": "S", "RSEED": 2150.0, "OPTIONS": "OP",
    "WATER": "N", "NITRO": "N", "SYMBI": "N", "PHOSP": "N", "POTAS": "N", "DISES": "N", "CHEM": "N", "TILL": "N",
    "CO2": "M", "METHODS": "ME", "WTHER": "M", "INCON": "M", "LIGHT": "E", "EVAPO": "R", "INFIL": "S", "PHOTO": "L",
    "HYDRO": "R", "NSWIT": 1.0, "MESOM": "G", "MESEV": "R", "MESOL": 2.0, "MANAGEMENT": "MA", "PLANT": "R",
    "IRRIG": "N", "FERTI": "N", "RESID": "N", "HARVS": "M", "OUTPUTS": "OU", "FNAME": "N", "OVVEW": "Y",
    "SUMRY": "Y", "FROPT": 1.0, "GROUT": "N", "CAOUT": "N", "WAOUT": "N", "NIOUT": "N", "MIOUT": "N", "DIOUT": "N",
    "VBOSE": "N", "CHOUT": "N", "OPOUT": "N", "FMOPT": "A", "PLANTING": "PL", "IRRIGATION": "IR", "NITROGEN": "NI",
    "RESIDUES": "RE", "HARVEST": "HA", "SIMDATES": "SI",
}

# The row an absent section gets.
SECTION_DEFAULTS = {
    "GENERAL": {},
    "TREATMENTS": {
        "N": 1.0, "R": 0.0, "O": 0.0, "C": 0.0, "TNAME": "", "CU": 1.0, "FL": 1.0, "SA": 0.0, "IC": 0.0, "MP": 1.0,
        "MI": 0.0, "MF": 0.0, "MR": 0.0, "MC": 0.0, "MT": 0.0, "ME": 0.0, "MH": 0.0, "SM": 1.0,
    },
    "CULTIVARS": {"C": 1.0, "CR": "FA", "INGENO": "IB0001", "CNAME": ""},
    "FIELDS": {"L": 1.0},
    "PLANTING_DETAILS": {"P": 1.0},
    "SIMULATION_CONTROLS": CONTROL_DEFAULTS,
}

SOIL_DDL = (
    "PEDON string, SOURCE string, TEXTURE string, DEPTH double, DESCRIPTION string, SITE string, COUNTRY string, "
    "LAT double, LONG double, SCS_FAMILY string, SCOM string, SALB double, SLU1 double, SLDR double, SLRO double, "
    "SLNF double, SLPF double, SMHB string, SMPX string, SMKE string, SLB array<double>, SLMH array<string>, "
    "SLLL array<double>, SDUL array<double>, SSAT array<double>, SRGF array<double>, SSKS array<double>, "
    "SBDM array<double>, SLOC array<double>, SLCL array<double>, SLSI array<double>, SLCF array<double>, "
    "SLNI array<double>, SLHW array<double>, SLHB array<double>, SCEC array<double>, SADC array<double>"
)

WEATHER_DDL = (
    "DATE date, SRAD double, TMAX double, TMIN double, RAIN double, DEWP double, WIND double, PAR double, "
    "EVAP double, RHUM double"
)

SECTIONS = {name: _schema(ddl) for name, ddl in SECTION_DDL.items()}
SOIL = _schema(SOIL_DDL)
WEATHER = _schema(WEATHER_DDL)
SECTION_ORDER = list(SECTION_DDL)
REQUIRED_SECTIONS = ("TREATMENTS", "CULTIVARS", "FIELDS", "PLANTING_DETAILS")

# Index columns shifted to start at 1 within a year, in the sections and in TREATMENTS.
SECTION_IDS = ("N", "C", "L", "A", "P", "T", "I", "F", "R", "E", "H")
TREATMENT_IDS = ("CU", "FL", "SA", "IC", "MP", "MI", "MF", "MR", "MC", "MT", "ME", "MH", "SM")

# Titles and heads of the management file. A cell ends under its column's name; names of LEFT_CELLS
# start their cell instead. The first block of a section has one line per record, the blocks of LIST_HEADS one per layer.
SECTION_TITLES = {
    "GENERAL": "*GENERAL",
    "TREATMENTS": "*TREATMENTS                        -------------FACTOR LEVELS------------",
    "CULTIVARS": "*CULTIVARS",
    "FIELDS": "*FIELDS",
    "SOIL_ANALYSIS": "*SOIL ANALYSIS",
    "INITIAL_CONDITIONS": "*INITIAL CONDITIONS",
    "PLANTING_DETAILS": "*PLANTING DETAILS",
    "TILLAGE": "*TILLAGE AND ROTATIONS",
    "IRRIGATION": "*IRRIGATION AND WATER MANAGEMENT",
    "FERTILIZERS": "*FERTILIZERS (INORGANIC)",
    "RESIDUES": "*RESIDUES AND ORGANIC FERTILIZER",
    "CHEMICALS": "*CHEMICAL APPLICATIONS",
    "ENVIRONMENT_MODIFICATIONS": "*ENVIRONMENT MODIFICATIONS",
    "HARVEST": "*HARVEST DETAILS",
    "SIMULATION_CONTROLS": "*SIMULATION CONTROLS",
}
SECTION_HEADS = {
    "GENERAL": [
        "@PEOPLE", "@ADDRESS", "@SITE",
        "@ PAREA  PRNO  PLEN  PLDR  PLSP  PLAY HAREA  HRNO  HLEN  HARM.........",
    ],
    "TREATMENTS": ["@N R O C TNAME.................... CU FL SA IC MP MI MF MR MC MT ME MH SM"],
    "CULTIVARS": ["@C CR INGENO CNAME"],
    "FIELDS": [
        "@L ID_FIELD WSTA....  FLSA  FLOB  FLDT  FLDD  FLDS  FLST SLTX  SLDP  ID_SOIL    FLNAME",
        "@L ...........XCRD ...........YCRD .....ELEV .............AREA .SLEN .FLWR .SLAS FLHST FHDUR",
    ],
    "SOIL_ANALYSIS": ["@A SADAT  SMHB  SMPX  SMKE  SANAME"],
    "INITIAL_CONDITIONS": ["@C   PCR ICDAT  ICRT  ICND  ICRN  ICRE  ICWD ICRES ICREN ICREP ICRIP ICRID ICNAME"],
    "PLANTING_DETAILS": [
        "@P PDATE EDATE  PPOP  PPOE  PLME  PLDS  PLRS  PLRD  PLDP  PLWT  PAGE  PENV  PLPH  SPRL                        PLNAME"
    ],
    "TILLAGE": ["@T TDATE TIMPL  TDEP TNAME"],
    "IRRIGATION": ["@I  EFIR  IDEP  ITHR  IEPT  IOFF  IAME  IAMT IRNAME"],
    "FERTILIZERS": ["@F FDATE  FMCD  FACD  FDEP  FAMN  FAMP  FAMK  FAMC  FAMO  FOCD FERNAME"],
    "RESIDUES": ["@R RDATE  RCOD  RAMT  RESN  RESP  RESK  RINP  RDEP  RMET RENAME"],
    "CHEMICALS": ["@C CDATE CHCOD CHAMT  CHME CHDEP CHT..  CHNAME"],
    "ENVIRONMENT_MODIFICATIONS": ["@E ODATE  EDAY  ERAD  EMAX  EMIN ERAIN  ECO2  EDEW EWIND ENVNAME"],
    "HARVEST": ["@H HDATE  HSTG  HCOM HSIZE   HPC  HBPC HNAME"],
    "SIMULATION_CONTROLS": [
        "@N GENERAL     NYERS NREPS START SDATE RSEED SNAME                     SMODEL  ",
        "@N OPTIONS     WATER NITRO SYMBI PHOSP POTAS DISES  CHEM  TILL   CO2",
        "@N METHODS     WTHER INCON LIGHT EVAPO INFIL PHOTO HYDRO NSWIT MESOM MESEV MESOL",
        "@N MANAGEMENT  PLANT IRRIG FERTI RESID HARVS",
        "@N OUTPUTS     FNAME OVVEW SUMRY FROPT GROUT CAOUT WAOUT NIOUT MIOUT DIOUT VBOSE CHOUT OPOUT FMOPT",
        "@N PLANTING    PFRST PLAST PH2OL PH2OU PH2OD PSTMX PSTMN",
        "@N IRRIGATION  IMDEP ITHRL ITHRU IROFF IMETH IRAMT IREFF",
        "@N NITROGEN    NMDEP NMTHR NAMNT NCODE NAOFF",
        "@N RESIDUES    RIPCN RTIME RIDEP",
        "@N HARVEST     HFRST HLAST HPCNP HPCNR",
        "@N SIMDATES    ENDAT    SDUR   FODAT  FSTRYR  FENDYR FWFILE           FONAME",
    ],
}
LIST_HEADS = {
    "GENERAL": "@NOTES",
    "SOIL_ANALYSIS": "@A  SABL  SADM  SAOC  SANI SAPHW SAPHB  SAPX  SAKE  SASC",
    "INITIAL_CONDITIONS": "@C  ICBL  SH2O  SNH4  SNO3",
    "IRRIGATION": "@I IDATE  IROP IRVAL",
}
LEFT_CELLS = (
    "PEOPLE", "ADDRESS", "SITE", "HARM", "NOTES", "TNAME", "CR", "CNAME", "ID_FIELD", "WSTA", "SLTX", "ID_SOIL", "FLNAME", "SANAME", "ICNAME",
    "PLNAME", "IRNAME", "FERNAME", "RENAME", "CHT", "CHNAME", "ENVNAME", "HNAME", "GENERAL", "SNAME", "SMODEL", "OPTIONS", "METHODS",
    "MANAGEMENT", "OUTPUTS", "PLANTING", "IRRIGATION", "NITROGEN", "RESIDUES", "HARVEST", "SIMDATES", "FWFILE", "FONAME",
)
# Decimals of printed numbers; others have none.
DECIMALS = {
    "XCRD": 6, "YCRD": 6, "ELEV": 1, "PAREA": 1, "PLEN": 1, "HAREA": 1, "HLEN": 1, "SLDP": 1, "SLEN": 1, "SADM": 2, "SAOC": 2, "SANI": 2, "SAPHW": 1,
    "SAPHB": 1, "SAPX": 1, "SAKE": 1, "SASC": 2, "SH2O": 3, "SNH4": 1, "SNO3": 1, "ICRES": 1, "ICREN": 2, "ICREP": 2, "PPOP": 1, "PPOE": 1,
    "PLRS": 1, "PLDP": 1, "PENV": 1, "PLPH": 1, "SPRL": 1, "TDEP": 1, "EFIR": 2, "IAMT": 1, "IRVAL": 1, "RESN": 2, "RESP": 2, "RESK": 2, "CHAMT": 2,
    "ERAD": 1, "EMAX": 1, "EMIN": 1, "ERAIN": 1, "EDEW": 1, "EWIND": 1,
}

# Print formats of the observed summary, observed time series and weather files.
SUMMARY_FORMATS = {
    "TRTNO": "%6.0f", "ADAT": "%6s", "BWAH": "%6.0f", "CNAM": "%6.1f", "CWAH": "%6.0f", "CWAM": "%6.0f",
    "GN%M": "%6.2f", "GNAM": "%6.1f", "H#AM": "%6.0f", "H#UM": "%6.0f", "HDAT": "%6s", "HWAHF": "%6.0f",
    "HWAH": "%6.0f", "HWAM": "%6.0f", "HWUM": "%6.1f", "LAIX": "%6.2f", "MDAT": "%6s", "EDAT": "%6s",
    "SNAM": "%6.1f", "TDAT": "%6s",
}
SERIES_FORMATS = {"DATE": "%6s", "TRTNO": "%6.0f", "CDAD": "%6.0f", "VN%D": "%6.0f", "VNAD": "%6.0f"}
WEATHER_FORMATS = {
    "DATE": "%5s", "SRAD": "%6.1f", "TMAX": "%6.1f", "TMIN": "%6.1f", "RAIN": "%6.1f", "DEWP": "%6.1f",
    "WIND": "%6.0f", "PAR": "%6.1f", "EVAP": "%6.1f", "RHUM": "%6.1f",
}
HEADER_FORMATS = {
    "INSI": "%6s", "LAT": "%9.3f", "LONG": "%9.3f", "ELEV": "%6.0f", "TAV": "%6.1f", "AMP": "%6.1f",
    "REFHT": "%6.1f", "WNDHT": "%6.1f",
}
SOIL_BLOCKS = [
    {"SITE": "%12s", "COUNTRY": "%12s", "LAT": "%9.3f", "LONG": "%9.3f", "SCS_FAMILY": "%18s"},
    {
        "SCOM": "%6s", "SALB": "%6.2f", "SLU1": "%6.1f", "SLDR": "%6.2f", "SLRO": "%6.1f", "SLNF": "%6.2f", "SLPF": "%6.2f",
        "SMHB": "%6s", "SMPX": "%6s", "SMKE": "%6s",
    },
]
LAYER_FORMATS = {
    "SLB": "%6.0f", "SLMH": "%6s", "SLLL": "%6.3f", "SDUL": "%6.3f", "SSAT": "%6.3f", "SRGF": "%6.3f", "SSKS": "%6.2f",
    "SBDM": "%6.2f", "SLOC": "%6.2f", "SLCL": "%6.1f", "SLSI": "%6.1f", "SLCF": "%6.1f", "SLNI": "%6.2f",
    "SLHW": "%6.1f", "SLHB": "%6.1f", "SCEC": "%6.1f", "SADC": "%6.1f",
}
