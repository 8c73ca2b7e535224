from creditweave.plans.batch import CLEAN_TABLE, batch_record, publish_batch, read_output, remove_old_runs, run_batch

__all__ = ["CLEAN_TABLE", "batch_record", "publish_batch", "read_output", "remove_old_runs", "run_batch"]
