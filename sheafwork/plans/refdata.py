"""PIP-04: code tables for the vehicle panels."""

from __future__ import annotations

# Region name -> country code, with pseudo-codes for aggregates.
REGION_CODES = {
    "Albania": "AL", "Austria": "AT", "Belgium": "BE", "Bulgaria": "BG",
    "Croatia": "HR", "Cyprus": "CY", "Czech Republic": "CZ", "Denmark": "DK",
    "Estonia": "EE", "Finland": "FI", "France": "FR", "Germany": "DE",
    "Greece": "GR", "Hungary": "HU", "Iceland": "IS", "Ireland": "IE",
    "Italy": "IT", "Latvia": "LV", "Lithuania": "LT", "Luxembourg": "LU",
    "Malta": "MT", "Netherlands": "NL", "Norway": "NO", "Poland": "PL",
    "Portugal": "PT", "Romania": "RO", "Slovakia": "SK", "Slovenia": "SI",
    "Spain": "ES", "Sweden": "SE", "Switzerland": "CH", "United Kingdom": "GB",
    "United States of America": "US", "Canada": "CA", "Brazil": "BR",
    "Chile": "CL", "Mexico": "MX",
    "Australia": "AU", "China": "CN", "India": "IN", "Japan": "JP",
    "New Zealand": "NZ", "South Korea": "KR", "Thailand": "TH",
    "Israel": "IL", "Morocco": "MA", "South Africa": "ZA",
    "World": "WORLD", "Europe": "EUR", "EU27": "EU27",
    "Rest of the world": "ROW", "Other Europe": "EUR_OTHER",
    "Other Asia Pacific": "APAC_OTHER",
}

# Fuel code -> label.
FUEL_LABELS = {
    "ELC": "Electric (BEV)",
    "ELC_PET_PI": "Plug-in hybrid petrol (PHEV)",
    "ELC_DIE_PI": "Plug-in hybrid diesel (PHEV)",
    "ELC_PET_HYB": "Hybrid petrol (non-plug-in)",
    "ELC_DIE_HYB": "Hybrid diesel (non-plug-in)",
    "PET": "Petrol (ICE)",
    "DIE": "Diesel (ICE)",
    "LPG": "LPG",
    "GAS": "Natural gas",
    "HYD_FCELL": "Hydrogen fuel cell",
    "ALT": "All alternative fuels",
    "BIFUEL": "Bifuel",
    "BIOETH": "Bioethanol",
    "BIODIE": "Biodiesel",
    "OTH": "Other",
    "TOTAL": "Total",
}

# Fuel code -> category.
FUEL_CATEGORIES = {
    "ELC": "Electric", "ELC_PET_PI": "Electric", "ELC_DIE_PI": "Electric",
    "ELC_PET_HYB": "Hybrid", "ELC_DIE_HYB": "Hybrid",
    "PET": "ICE", "DIE": "ICE",
    "LPG": "Other", "GAS": "Other", "HYD_FCELL": "Other", "ALT": "Other",
    "BIFUEL": "Other", "BIOETH": "Other", "BIODIE": "Other", "OTH": "Other",
    "TOTAL": "Total",
}

# Codes that sum up other codes of the same table.
AGGREGATE_FUELS = ("ALT",)

# Geo codes that are groups of countries.
AGGREGATE_GEOS = ("EU27_2020", "EU28", "EEA", "EA19", "EA20")

# Member countries of the peer benchmark.
MEMBERS = (
    "AT", "BE", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR", "DE", "GR",
    "HU", "IE", "IT", "LV", "LT", "LU", "MT", "NL", "PL", "PT", "RO", "SK",
    "SI", "ES", "SE",
)

# Other spellings of a country code.
GEO_ALIASES = {"EL": "GR", "UK": "GB"}


def stock_labels() -> dict[str, str]:
    """Labels of the stock table: the same, without the engine-type suffix."""
    return {code: label.replace(" (ICE)", "") for code, label in FUEL_LABELS.items()}


def stock_categories() -> dict[str, str]:
    """Categories of the stock table, which names ICE 'Combustion'."""
    return {code: "Combustion" if cat == "ICE" else cat for code, cat in FUEL_CATEGORIES.items()}
