from fieldlens.sinks.writers import (VersionConflict, list_versions, publish_version, read_latest_version, release_claim,
                                    update_version, with_row_numbers, write_by_month, write_csv,
                                    write_snapshot_and_latest, write_split)

__all__ = ["write_csv", "with_row_numbers", "write_snapshot_and_latest", "write_split", "write_by_month",
           "publish_version", "read_latest_version", "list_versions", "update_version", "release_claim", "VersionConflict"]
