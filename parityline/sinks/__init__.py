"""Writers for manifests, view keys and staged samples."""
