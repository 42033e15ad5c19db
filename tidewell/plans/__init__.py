from .sync import SyncResult, landed_records, sync_all, sync_landed, sync_table

__all__ = ["SyncResult", "landed_records", "sync_all", "sync_landed", "sync_table"]
