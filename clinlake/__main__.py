from clinlake.cli import main

raise SystemExit(main())
