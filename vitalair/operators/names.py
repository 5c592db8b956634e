"""Published names of measures."""

from __future__ import annotations

#: Visit table, column of the joined series -> published name.
VISIT_NAMES = {
    "pm25_avg_prev_date": "Avg24hPM2.5Exposure",
    "pm25_max_prev_date": "Max24hPM2.5Exposure",
    "o3_avg_prev_date": "Avg24hOzoneExposure",
    "o3_max_prev_date": "Max24hOzoneExposure",
    "pm25_daily_average_prev_date": "Avg24hPM2.5Exposure_2",
    "ozone_daily_8hour_maximum_prev_date": "Max24hOzoneExposure_2",
    "CO_ppbv_prev_date": "Avg24hCOExposure_2",
    "NO_ppbv_prev_date": "Avg24hNOExposure_2",
    "NO2_ppbv_prev_date": "Avg24hNO2Exposure_2",
    "NOX_ppbv_prev_date": "Avg24hNOxExposure_2",
    "SO2_ppbv_prev_date": "Avg24hSO2Exposure_2",
    "ALD2_ppbv_prev_date": "Avg24hAcetaldehydeExposure_2",
    "FORM_ppbv_prev_date": "Avg24hFormaldehydeExposure_2",
    "BENZ_ppbv_prev_date": "Avg24hBenzeneExposure_2",
}

#: Patient table, likewise.
PATIENT_NAMES = {
    "pm25_avg": "AvgDailyPM2.5Exposure",
    "pm25_avg_avg": "AvgDailyPM2.5Exposure_StudyAvg",
    "pm25_avg_max": "AvgDailyPM2.5Exposure_StudyMax",
    "pm25_max": "MaxDailyPM2.5Exposure",
    "pm25_max_avg": "MaxDailyPM2.5Exposure_StudyAvg",
    "pm25_max_max": "MaxDailyPM2.5Exposure_StudyMax",
    "o3_avg": "AvgDailyOzoneExposure",
    "o3_avg_avg": "AvgDailyOzoneExposure_StudyAvg",
    "o3_avg_max": "AvgDailyOzoneExposure_StudyMax",
    "o3_max": "MaxDailyOzoneExposure",
    "o3_max_avg": "MaxDailyOzoneExposure_StudyAvg",
    "o3_max_max": "MaxDailyOzoneExposure_StudyMax",
    "pm25_daily_average_avg": "AvgDailyPM2.5Exposure_2",
    "ozone_daily_8hour_maximum_avg": "MaxDailyOzoneExposure_2",
    "CO_ppbv_avg": "AvgDailyCOExposure_2",
    "NO_ppbv_avg": "AvgDailyNOExposure_2",
    "NO2_ppbv_avg": "AvgDailyNO2Exposure_2",
    "NOX_ppbv_avg": "AvgDailyNOxExposure_2",
    "SO2_ppbv_avg": "AvgDailySO2Exposure_2",
    "ALD2_ppbv_avg": "AvgDailyAcetaldehydeExposure_2",
    "FORM_ppbv_avg": "AvgDailyFormaldehydeExposure_2",
    "BENZ_ppbv_avg": "AvgDailyBenzeneExposure_2",
}


def column_name(published: str) -> str:
    """A published name without dots, for use where a dot would be read as a field."""
    return published.replace(".", "_")
