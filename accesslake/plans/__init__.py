"""Day jobs that wire readers, operators and writers together."""

from accesslake.plans.jobs import (
    JobReport,
    ads_from_text_job,
    ads_job,
    dwd_job,
    dwd_text_job,
    export_job,
    ods_job,
    ods_table_job,
    ods_text_job,
    report_job,
)

__all__ = [
    "JobReport", "ads_from_text_job", "ads_job", "dwd_job", "dwd_text_job", "export_job",
    "ods_job", "ods_table_job", "ods_text_job", "report_job",
]
