"""Fixed values of the feature definition.

Literals and output names must stay exactly as they are, misspellings and
near-duplicates included: they decide which raw values count and under which
name the result is stored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

VISITOR = "fullVisitorId"


@dataclass(frozen=True)
class Indicator:
    """One 0/1 output column: did ``field`` ever equal ``literal``?"""

    group: str
    field: str
    literal: str
    column: str


# Literal -> output column, per source field.
DEVICE_CATEGORIES = {
    "mobile": "device_deviceCategory_mobile",
    "desktop": "device_deviceCategory_desktop",
    "tablet": "device_deviceCategory_tablet",
}

BROWSERS = {
    "Chrome": "device_browser_Chrome",
    "Safari": "device_browser_Safari",
    "Firefox": "device_browser_Firefox",
    "Edge": "device_browser_Edge",
}

CHANNELS = {
    "Display": "channelGrouping_Display",
    "Organic Search": "channelGrouping_OrganicSearch",
    "Social": "channelGrouping_Social",
    "Direct": "channelGrouping_Direct",
    "Referral": "channelGrouping_Referal",
    "Paid Search": "channelGrouping_Paid_Search",
    "(Other)": "channelGrouping_Other",
    "Affiliates": "channelGrouping_Affiliates",
}

PAGES_LEVEL_2 = {
    "/brands/": "hitspagepagePathLevel2_brands",
    "/quickview": "hitspagepagePathLevel2_quickview",
    "/lifestyle": "hitspagepagePathLevel2_lifestyle",
    "/lifestyle/": "hitspagepagePathLevel2_lifestyle2",
    "/return-policy": "hitspagepagePathLevel2_returnpolicy",
    "/terms-of-use/": "hitspagepagePathLevel2_termsofuse",
    "/faqs": "hitspagepagePathLevel2_faqs",
    "/frequently-asked-questions/": "hitspagepagePathLevel2_faq",
    "/shop+by+brand": "hitspagepagePathLevel2_shopbybrand",
    "/shop+by+brand/": "hitspagepagePathLevel2_shopbybrand2",
}

PAGES_LEVEL_3 = {
    "/men": "hitspagepagePathLevel3_men",
    "/mens": "hitspagepagePathLevel3_mens",
    "/mens/": "hitspagepagePathLevel3_mens2",
    "/womens": "hitspagepagePathLevel3_womens",
    "/womens/": "hitspagepagePathLevel3_womens2",
    "/quickview": "hitspagepagePathLevel3_quickview",
    "/return-policy": "hitspagepagePathLevel3_returnpolicy",
    "/store-policies/": "hitspagepagePathLevel3_storepolicies",
    "/frequently-asked-questions/": "hitspagepagePathLevel3_faq",
}

METROS = [
    "Albany-Schenectady-Troy NY",
    "Atlanta GA",
    "Augusta GA",
    "Austin TX",
    "Baltimore MD",
    "Boise ID",
    "Boston MA-Manchester NH",
    "Butte-Bozeman MT",
    "Charleston SC",
    "Charlotte NC",
    "Charlottesville VA",
    "Chattanooga TN",
    "Chicago IL",
    "Chico-Redding CA",
    "Cincinnati OH",
    "Cleveland-Akron (Canton) OH",
    "Colorado Springs-Pueblo CO",
    "Columbus OH",
    "Dallas-Ft. Worth TX",
    "Denver CO",
    "Detroit MI",
    "El Paso TX",
    "Fresno-Visalia CA",
    "Grand Rapids-Kalamazoo-Battle Creek MI",
    "Green Bay-Appleton WI",
    "Harlingen-Weslaco-Brownsville-McAllen TX",
    "Hartford & New Haven CT",
    "Honolulu HI",
    "Houston TX",
    "Idaho Falls-Pocatello ID",
    "Indianapolis IN",
    "Jacksonville FL",
    "Kansas City MO",
    "La Crosse-Eau Claire WI",
    "Lansing MI",
    "Las Vegas NV",
    "Lexington KY",
    "Los Angeles CA",
    "Louisville KY",
    "Madison WI",
    "Mankato MN",
    "Memphis TN",
    "Miami-Ft. Lauderdale FL",
    "Milwaukee WI",
    "Minneapolis-St. Paul MN",
    "Nashville TN",
    "New Orleans LA",
    "New York NY",
    "Norfolk-Portsmouth-Newport News VA",
    "Omaha NE",
    "Orlando-Daytona Beach-Melbourne FL",
    "Panama City FL",
    "Philadelphia PA",
    "Phoenix AZ",
    "Pittsburgh PA",
    "Portland OR",
    "Providence-New Bedford,MA",
    "Raleigh-Durham (Fayetteville) NC",
    "Roanoke-Lynchburg VA",
    "Rochester-Mason City-Austin,IA",
    "Sacramento-Stockton-Modesto CA",
    "Salt Lake City UT",
    "San Antonio TX",
    "San Diego CA",
    "San Francisco-Oakland-San Jose CA",
    "Seattle-Tacoma WA",
    "Springfield MO",
    "St. Louis MO",
    "Syracuse NY",
    "Tallahassee FL-Thomasville GA",
    "Tampa-St. Petersburg (Sarasota) FL",
    "Tri-Cities TN-VA",
    "Tucson (Sierra Vista) AZ",
    "Tulsa OK",
    "Utica NY",
    "Washington DC (Hagerstown MD)",
    "Weeling WV-Steubenville OH",
]

# Metro columns are the literal without punctuation and blanks, but for these.
METRO_COLUMN_EXCEPTIONS = {
    "Butte-Bozeman MT": "geoNetworkmetro_ButteBozemannMt",
    "Idaho Falls-Pocatello ID": "geoNetworkmetro_OdahoFallsPocatelloID",
    "Weeling WV-Steubenville OH": "geoNetworkmetro_WheelingWVSteubenvilleOH",
}


def _metro_column(metro: str) -> str:
    return METRO_COLUMN_EXCEPTIONS.get(metro, "geoNetworkmetro_" + re.sub(r"[^A-Za-z]", "", metro))


def _indicators(group: str, field: str, names: dict[str, str]) -> list[Indicator]:
    return [Indicator(group, field, literal, column) for literal, column in names.items()]


# Output order of the feature table.
INDICATORS: list[Indicator] = [
    *_indicators("device", "device.deviceCategory", DEVICE_CATEGORIES),
    *_indicators("browser", "device.browser", BROWSERS),
    *_indicators("channel", "channelGrouping", CHANNELS),
    *_indicators("page", "hits.page.pagePathLevel2", PAGES_LEVEL_2),
    *_indicators("page", "hits.page.pagePathLevel3", PAGES_LEVEL_3),
    *_indicators("metro", "geoNetwork.metro", {m: _metro_column(m) for m in METROS}),
]

# Weekday names, Sunday first (day number 1).
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# Daypart -> first hour, hour after the last one (local time).
# The last bucket runs over midnight; names and bounds disagree on purpose.
DAYPARTS = {
    "night_1_6": (1, 6),
    "morning_6_11": (6, 11),
    "lunch_11_14": (11, 14),
    "afternoon_14_17": (14, 17),
    "dinner_17_19": (17, 19),
    "evening_19_23": (19, 22),
    "latenight_23_1": (22, 25),
}

# Days (both inclusive) on which daylight saving adds one hour.
DST_RANGES = [
    ("20170312", "20171105"),
    ("20180311", "20181104"),
    ("20190310", "20191103"),
    ("20200308", "20201101"),
]

# Region name, hours from UTC, observes daylight saving.
STATES = [
    ("Alaska", -9, 1),
    ("American Samoa", -10, 0),
    ("Hawaii", -10, 0),
    ("California", -7, 1),
    ("Idaho", -7, 1),
    ("Nevada", -8, 1),
    ("Oregon", -8, 1),
    ("Washington", -8, 1),
    ("Arizona", -7, 0),
    ("Colorado", -7, 1),
    ("Kansas", -6, 1),
    ("Montana", -7, 1),
    ("North Dakota", -6, 1),
    ("Nebraska", -6, 1),
    ("New Mexico", -7, 1),
    ("South Dakota", -6, 1),
    ("Texas", -6, 1),
    ("Utah", -7, 1),
    ("Wyoming", -7, 1),
    ("Alabama", -6, 1),
    ("Arkansas", -6, 1),
    ("Florida", -5, 1),
    ("Iowa", -6, 1),
    ("Illinois", -6, 1),
    ("Indiana", -5, 1),
    ("Kentucky", -5, 1),
    ("Louisiana", -6, 1),
    ("Michigan", -5, 1),
    ("Minnesota", -6, 1),
    ("Missouri", -6, 1),
    ("Mississippi", -6, 1),
    ("Oklahoma", -6, 1),
    ("Tennessee", -5, 1),
    ("Wisconsin", -6, 1),
    ("Connecticut", -5, 1),
    ("District of Columbia", -5, 1),
    ("Delaware", -5, 1),
    ("Georgia", -5, 1),
    ("Massachusetts", -5, 1),
    ("Maryland", -5, 1),
    ("Maine", -5, 1),
    ("North Carolina", -5, 1),
    ("New Hampshire", -5, 1),
    ("New Jersey", -5, 1),
    ("New York", -5, 1),
    ("Ohio", -5, 1),
    ("Pennsylvania", -5, 1),
    ("Rhode Island", -5, 1),
    ("South Carolina", -5, 1),
    ("Virginia", -5, 1),
    ("Vermont", -5, 1),
    ("West Virginia", -5, 1),
    ("Puerto Rico", -4, 0),
    ("Virgin Islands", -4, 0),
]
