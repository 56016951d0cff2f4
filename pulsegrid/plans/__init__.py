from .batch import ANALYSES, profile_cube, run_batch, save_batch  # noqa: F401
from .report import daily_report  # noqa: F401
