from .graph import CycleError, Job, run_models, spec_job, topo_order

__all__ = ["CycleError", "Job", "run_models", "spec_job", "topo_order"]
