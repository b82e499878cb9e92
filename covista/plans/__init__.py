from covista.plans.approximate import approximate_search, build_index, recall  # noqa: F401
from covista.plans.components import components  # noqa: F401
from covista.plans.products import best_products  # noqa: F401
from covista.plans.ranking import as_array, first_rows, top_k, with_ordinal  # noqa: F401
from covista.plans.search import search  # noqa: F401
from covista.plans.shared import Workspace, remove_path, scratch_path, shared_dir, stored  # noqa: F401
from covista.plans.skew import WORK_ROWS, fan_out_join, key_counts, spread  # noqa: F401
