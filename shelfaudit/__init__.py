"""shelfaudit: retail field-audit reporting on Spark DataFrames.

Every operator is a DataFrame -> DataFrame function. Domain codes
(document types, attribute ids, name patterns, labels) come from an
``AuditCodes`` value passed by the caller; see ``shelfaudit.config``.

Entry points: ``run_audit_report`` (the live 38-column report),
``run_full_report`` (the ordered 42-column report) and ``export_photos``.
"""

from shelfaudit.config import REFERENCE_CODES, AuditCodes, ReportLabels
from shelfaudit.plans.full_report import run_full_report
from shelfaudit.plans.photos import export_photos
from shelfaudit.plans.report import run_audit_report
from shelfaudit.sources.tables import AuditTables

__all__ = [
    "AuditCodes", "AuditTables", "ReportLabels", "REFERENCE_CODES",
    "export_photos", "run_audit_report", "run_full_report",
]
