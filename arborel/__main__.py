from arborel.cli import main

raise SystemExit(main())
